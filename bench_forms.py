"""Time the pair table in several forms on the same stored records.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` as for ``bench.py``, ``BENCH_UDF=1`` adds the
Python form, which takes minutes.
"""

from __future__ import annotations

import itertools
import json
import os
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.entities import entity_names
from tidings.operators.cooccurrence import cooccurrence, cooccurrence_counts
from tidings.operators.records import multi_entity
from tidings.plans import tables
from tidings.session import build_session, stage

RUNS = 2


def exploded(records: DataFrame) -> DataFrame:
    names = multi_entity(records).select(entity_names("AllNames").alias("names"))
    first = names.select("names", F.explode("names").alias("name_a"))
    pairs = first.select("name_a", F.explode("names").alias("name_b"))
    return pairs.groupBy("name_a", "name_b").count()


def product(text):
    names = [item.partition(",")[0] for item in text.split(";")]
    return list(itertools.product(names, repeat=2))


def in_python(records: DataFrame) -> DataFrame:
    pairs_of = F.udf(product, "array<struct<name_a string, name_b string>>")
    pairs = multi_entity(records).select(F.explode(pairs_of("AllNames")).alias("pair"))
    return pairs.select("pair.*").groupBy("name_a", "name_b").count()


def one_window(counts: DataFrame) -> DataFrame:
    order = Window.orderBy(F.desc("count"), "name_a", "name_b")
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("rn", F.row_number().over(order)).withColumn(
        "weight", F.col("count") / total
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-forms",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    records = stage(tables.records(spark, sf_dir).repartition(int(cpus)), "records")

    forms = {
        "counts": lambda: cooccurrence_counts(records),
        "weighted": lambda: cooccurrence(records),
        "exploded_counts": lambda: exploded(records),
        "exploded_weighted": lambda: one_window(exploded(records)),
    }
    if os.environ.get("BENCH_UDF"):
        forms["udf_counts"] = lambda: in_python(records)
        forms["udf_weighted"] = lambda: one_window(in_python(records))

    seconds = {}
    for name, form in forms.items():
        for _ in range(RUNS):
            start = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 2)
    print(json.dumps({"unit": "sec", "run": RUNS, "forms": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()

"""The operators over the test tables, each with SQL that gives the same rows.

The SQL works on the base rows (one per found name) and not on the joined
strings, so that the two sides share no formulation.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions import entities, files, pairs
from tidings.operators import attributes, events
from tidings.operators import cooccurrence as cooc
from tidings.operators import files as file_ops
from tidings.operators import links, mentions, preview, ranking, records, scenes
from tidings.plans import alltime, tables
from tidings.plans.daily import RESULTS, run_daily
from tidings.session import drop_path, drop_staged, new_path, stage
from tidings.sources import archives, bucketed, datasets, flat, sinks
from tidings.streaming import ledger
from tidings.streaming.ingest import start_ingest

TOP = 20
DAY = 20150220
POINT = (-122.437, 37.72)
DAYS = ("2024-01-05", "2024-01-25")
LATEST = 10
STEPS = 10
EVENT_DAYS = (20240105, 20240124)
MENTION_DAYS = (19960101, 19991231)
BUCKETS = 16
# So low that the given tables have heavy events.
HEAVY_MENTIONS = 5


# Co-occurrence ---------------------------------------------------------------

def cooc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.records(spark, sf_dir).where(F.col("AllNames").contains(";"))
    return cooc.entity_pairs(found, "GKGRECORDID")


def cooc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence_counts(tables.records(spark, sf_dir))


def cooc_undirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence_counts(
        tables.records(spark, sf_dir), directed=False, self_pairs=False
    )


def cooc_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence_counts(tables.records(spark, sf_dir), "Themes")


def cooc_themes_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence_counts(tables.records(spark, sf_dir), "Themes", drop_empty=True)


def cooc_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.total_pairs(tables.records(spark, sf_dir))


def cooc_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence(tables.records(spark, sf_dir))


def cooc_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooc.cooccurrence_top(tables.records(spark, sf_dir), TOP)


def _pair_tasks(spark: SparkSession) -> int:
    return cooc.SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))


def cooc_sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The function that gives pairs as arrays, on parts of the lists; mirrors follow the count."""
    entities.register_functions(spark)
    found = tables.records(spark, sf_dir)
    return spark.sql(
        f"""
        WITH lists AS (SELECT name_parts(AllNames) AS parts FROM {{found}} WHERE AllNames LIKE '%;%'),
        tiles AS (
            SELECT a, b, count(*) AS copies FROM lists
            LATERAL VIEW OUTER posexplode(parts) x AS i, a
            LATERAL VIEW OUTER explode(slice(parts, i + 1, size(parts))) y AS b
            GROUP BY a, b),
        dealt AS (SELECT /*+ REPARTITION({_pair_tasks(spark)}, a, b) */ a, b, copies FROM tiles),
        arrays AS (SELECT a.n AS n_a, b.n AS n_b, copies, get_cooccurences(a.list, b.list) AS pairs FROM dealt),
        half AS (
            SELECT pair[0] AS name_a, pair[1] AS name_b,
                   sum(n_a[cast(at div size(n_b) AS INT)] * n_b[at % size(n_b)] * copies) AS count
            FROM arrays LATERAL VIEW OUTER posexplode(pairs) z AS at, pair
            WHERE pair[0] <= pair[1] GROUP BY pair[0], pair[1])
        SELECT p.name_a, p.name_b, count FROM (SELECT count, pair_directions(name_a, name_b) AS both FROM half)
        LATERAL VIEW OUTER explode(both) d AS p
        """,
        found=found,
    )


def cooc_sql_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function, which gives pairs as rows; mirrors follow the count."""
    pairs.register_pairs(spark)
    entities.register_functions(spark)
    found = tables.records(spark, sf_dir)
    return spark.sql(
        f"""
        WITH lists AS (SELECT AllNames, count(*) AS copies FROM {{found}} WHERE AllNames LIKE '%;%' GROUP BY AllNames),
        half AS (
            SELECT name_a, name_b, sum(n) AS count
            FROM name_pairs(TABLE(SELECT /*+ REPARTITION({_pair_tasks(spark)}, AllNames) */ AllNames, copies FROM lists), true)
            GROUP BY name_a, name_b)
        SELECT p.name_a, p.name_b, count FROM (SELECT count, pair_directions(name_a, name_b) AS both FROM half)
        LATERAL VIEW OUTER explode(both) d AS p
        """,
        found=found,
    )


def cooc_sql_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The function that gives names with their counts, each with itself and those after it; mirrors follow."""
    entities.register_functions(spark)
    found = tables.records(spark, sf_dir)
    return spark.sql(
        f"""
        WITH lists AS (
            SELECT names, count(*) AS copies
            FROM (SELECT name_counts(AllNames) AS names FROM {{found}} WHERE AllNames LIKE '%;%') GROUP BY names),
        dealt AS (SELECT /*+ REPARTITION({_pair_tasks(spark)}, names) */ names, copies FROM lists),
        half AS (
            SELECT a.name AS name_a, b.name AS name_b, sum(a.n * b.n * copies) AS count
            FROM dealt
            LATERAL VIEW OUTER posexplode(names) x AS i, a
            LATERAL VIEW OUTER explode(slice(names, i + 1, size(names))) y AS b
            GROUP BY a.name, b.name)
        SELECT p.name_a, p.name_b, count FROM (SELECT count, pair_directions(name_a, name_b) AS both FROM half)
        LATERAL VIEW OUTER explode(both) d AS p
        """,
        found=found,
    )


def entity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks after a fixed number of steps, names without a partner included."""
    found = stage(tables.records(spark, sf_dir).select("AllNames"), "names")
    pairs = cooc.cooccurrence_counts(found, directed=False, self_pairs=False)
    named = found.select(F.explode(entities.entity_names("AllNames")).alias("name"))
    return links.link_rank(pairs, named, iterations=STEPS, tolerance=-1.0)


def alltime_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair table kept by day, brought up to date as files arrive in turns, late ones last."""
    base = new_path(spark, "alltime")
    lines = tables.record_lines(spark, sf_dir)
    # In turns by the first character of the key: newer days first.
    for turn, part in enumerate((lines.where("line >= '5'"), lines.where("line < '5'"))):
        _land(part, "gkg", f"{base}/landed/{turn}", f"2015-03-0{2 - turn} 00:00:00")
        ledger.start_ledger_ingest(spark, f"{base}/landed/*", f"{base}/stored", f"{base}/progress").awaitTermination()
        alltime.update_pairs(spark, f"{base}/stored", f"{base}/pairs")
    return alltime.alltime_pairs(spark, f"{base}/pairs")


# Items, mentions, ranks ------------------------------------------------------

def multi_entity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.multi_entity(tables.records(spark, sf_dir))


def split_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.explode(entities.split_items("AllNames")).alias("item")
    return tables.records(spark, sf_dir).select("GKGRECORDID", items)


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.explode(entities.entity_names("AllNames")).alias("name")
    return tables.records(spark, sf_dir).select("GKGRECORDID", names)


def top_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Themes")


def top_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Persons")


def top_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Organizations")


def top_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Locations")


def themes_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Themes", drop_empty=False)


def top_values_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.top_mentions(tables.records(spark, sf_dir), "Organizations", exploded=False)


def rank_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mentions.mention_counts(tables.words(spark, sf_dir), "Words")
    return ranking.rank_by_count(counts, "Words")


# Projections, days, sinks ----------------------------------------------------

def master_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.master_view(tables.records(spark, sf_dir))


def _stored_records(spark: SparkSession, sf_dir: str) -> str:
    root = new_path(spark, "records")
    day = F.substring(F.col("DATE").cast("string"), 1, 8).cast("int")
    found = tables.records(spark, sf_dir).withColumn("ds", day)
    sinks.write_dataset(found, f"{root}/gkg")
    return root


def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = datasets.load_records(spark, _stored_records(spark, sf_dir), DAY)
    return stored.select("GKGRECORDID", "DATE", "AllNames", "ds")


def record_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = files.stamp_time("DATE")
    return tables.records(spark, sf_dir).select(
        "GKGRECORDID",
        files.day_text(time).alias("day"),
        F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("time"),
    )


def view_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets.register_views(spark, _stored_records(spark, sf_dir), DAY)
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{view}' AS view, count(*) AS rows FROM {view}"
        for view in ("records", "records_today", "master", "master_today", "multi_entity",
                     "multi_entity_today")
    ))


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that runs over all days and over one day have stored."""
    root = _stored_records(spark, sf_dir)
    report = None
    for run, day in (("all", "all"), ("day", DAY)):
        for name, df in run_daily(spark, root, f"{root}-{run}", day).items():
            cells = {"rn": "rn", "name_a": "name_a", "name_b": "name_b", "count": "count", "weight": "weight"}
            if name in RESULTS:
                cells = {"rn": "cast(NULL AS BIGINT)", "name_a": RESULTS[name], "name_b": "cast(NULL AS STRING)",
                         "count": "count", "weight": "cast(NULL AS DOUBLE)"}
            rows = df.selectExpr(f"'{run}' AS run", f"'{name}' AS result", *(f"{x} AS {c}" for c, x in cells.items()))
            report = rows if report is None else report.unionByName(rows)
    return report


def stored_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, run_ts = new_path(spark, "results"), sinks.run_stamp()
    top = mentions.top_mentions(tables.records(spark, sf_dir), "Organizations")
    stored = sinks.write_result(top, out, "organizations", run_ts)
    return spark.read.schema(stored.schema).json(f"{out}/organizations_json/run_ts={run_ts}")


# Events ----------------------------------------------------------------------

def event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of some days with their mentions of others, both stored in buckets first."""
    # The mentions of the given tables are spread over years, so a partition is one of them.
    year = F.substring(F.col("MentionTimeDate").cast("string"), 1, 4).cast("int") * 10_000 + 101
    stored = []
    for lines, label, day in ((tables.event_lines, "events", F.col("SQLDATE")), (tables.mention_lines, "mentions", year)):
        found = datasets.parse_lines(lines(spark, sf_dir), label)
        typed = stage(found.select("*", day.alias("ds")).drop("_corrupt_record"), label)
        path = new_path(spark, label)
        name = f"{label}_{path.rsplit('-', 1)[1]}"
        stored.append(bucketed.write_bucketed(typed, name, path, events.EVENT_KEY, BUCKETS, HEAVY_MENTIONS))
        drop_staged(typed)
    return events.events_with_mentions(
        *stored, ["ds", "EventCode", "AvgTone"], ["MentionTimeDate", "MentionType", "Confidence"],
        EVENT_DAYS, MENTION_DAYS, HEAVY_MENTIONS)


def records_with_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what held for their customer at the time; intervals overlap, miss and are open."""
    orders = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("time"))
    held = tables.intervals(spark, sf_dir)
    got = attributes.with_attributes(orders, held, "o_custkey", "time", ["state", "number"])
    return got.select("o_orderkey", "state", "number")


# Files, manifests, typed scans -----------------------------------------------

def url_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return file_ops.extract_urls(pages.select(F.concat_ws(" ", "url", "html").alias("value")))


def manifest_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_ops.parse_manifest(tables.manifest(spark, sf_dir))


def latest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = file_ops.parse_manifest(tables.manifest(spark, sf_dir))
    return file_ops.latest_files(listed, LATEST).select("stamp", "file_name", "dataset")


def route_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = file_ops.extract_urls(tables.manifest(spark, sf_dir))
    return file_ops.route_files(listed).groupBy("dataset").agg(F.count("*").alias("files"))


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(name: str, key: str) -> DataFrame:
        file = F.concat(F.lit("batch-"), F.col(key).cast("string"), F.lit(".gkg.csv.zip"))
        return tables.table(spark, sf_dir, name).select(file.alias("source_file"))

    return file_ops.only_new_files(names("events", "event_id"), names("documents", "doc_id"))


def backfill_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest files not stored yet, where those of clicks and views are stored by day."""
    lines = tables.manifest(spark, sf_dir)
    listed = file_ops.parse_manifest(lines)
    stored = listed.where("dataset IN ('gkg', 'events')").select(
        F.col("file_name").alias("source_file"), files.day_of("file_name").alias("ds"))
    path = new_path(spark, "stored")
    sinks.write_dataset(stored, path)
    return file_ops.missing_files(lines, spark.read.schema(stored.schema).parquet(path))


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = datasets.parse_lines(tables.record_lines(spark, sf_dir), "gkg")
    return typed.withColumnRenamed("_corrupt_record", "bad")


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = datasets.parse_lines(tables.event_lines(spark, sf_dir), "events")
    return typed.withColumnRenamed("_corrupt_record", "bad")


def typed_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = datasets.parse_lines(tables.mention_lines(spark, sf_dir), "mentions")
    return typed.withColumnRenamed("_corrupt_record", "bad")


def typed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "mentions")
    tables.mention_lines(spark, sf_dir).write.text(path)
    return datasets.read_dataset(spark, path, "mentions").drop("_corrupt_record")


FLAT = ["GKGRECORDID", "DATE", "SourceCollectionIdentifier", "AllNames", "Locations"]


def flat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a flat folder whose types differ from day to day."""
    folder = new_path(spark, "flat")
    tables.flat_files(spark, sf_dir, folder)
    return flat.load_files(spark, folder, columns=FLAT).select(*FLAT, "ds")


def flat_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of one day."""
    folder = new_path(spark, "flat")
    tables.flat_files(spark, sf_dir, folder)
    return flat.load_files(spark, folder, DAY, columns=FLAT).select(*FLAT, "ds")


def unzipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = tables.archives(tables.event_lines(spark, sf_dir), "events")
    lines = archives.unzip_lines(packed)
    typed = datasets.parse_lines(lines.withColumn("dataset", files.dataset_of("path")), "events")
    return typed.select("dataset", "error", "GLOBALEVENTID", "EventCode", "AvgTone", "SOURCEURL")


# Of each dataset: its key, two texts and a number.
SHOWN = {
    "gkg": ("GKGRECORDID", "AllNames", "Locations", "SourceCollectionIdentifier"),
    "events": ("GLOBALEVENTID", "EventCode", "SOURCEURL", "AvgTone"),
    "mentions": ("GLOBALEVENTID", "MentionSourceName", "MentionIdentifier", "MentionDocTone"),
}


def _shown(load) -> DataFrame:
    """Key, day and fields of the rows of all datasets, and the text of lines that are malformed."""
    out = None
    for kind, (key, first, second, number) in SHOWN.items():
        rows = load(kind).select(
            F.lit(kind).alias("dataset"), F.col(key).cast("bigint").alias("key"), "ds", F.col(first).alias("first"),
            F.col(second).alias("second"), F.col(number).cast("double").alias("number"),
            F.col("_corrupt_record").alias("bad"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _land(lines: DataFrame, kind: str, folder: str, first: str = tables.FIRST_STAMP) -> None:
    tables.archives(lines, kind, folder, first).write.format("noop").mode("overwrite").save()


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows stored from archives of all three datasets by the ingest queries, run twice."""
    base = new_path(spark, "ingest")
    for kind, lines in tables.LINES.items():
        _land(lines(spark, sf_dir), kind, f"{base}/landed")
    for _ in range(2):
        running = start_ingest(spark, f"{base}/landed", f"{base}/stored", f"{base}/progress")
        for query in running.values():
            query.awaitTermination()
    return _shown(lambda kind: datasets.load_records(spark, f"{base}/stored", kind=kind))


def ingest_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the ledger after files came late, came again under their name, and a batch was repeated."""
    base = new_path(spark, "ledger")
    landed, root, progress = f"{base}/landed", f"{base}/stored", f"{base}/progress"

    def run() -> None:
        ledger.start_ledger_ingest(spark, f"{landed}/*", root, progress).awaitTermination()

    _land(tables.mention_lines(spark, sf_dir), "mentions", f"{landed}/a")
    _land(tables.event_lines(spark, sf_dir), "events", f"{landed}/a")
    run()
    # Stamps before all that is stored.
    _land(tables.record_lines(spark, sf_dir), "gkg", f"{landed}/b", "2014-01-01 00:00:00")
    run()
    # The names of the first run in another folder, with other lines.
    other = tables.event_lines(spark, sf_dir).select(F.concat(F.lit("9"), "line").alias("line"))
    _land(other, "events", f"{landed}/c")
    run()
    # As if the second batch had stopped before its end.
    drop_path(spark, f"{progress}/commits/2")
    drop_path(spark, f"{progress}/commits/1")
    run()
    return _shown(lambda kind: ledger.load_ingested(spark, root, kind))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of files of no known dataset, and what could not be unpacked, next to events that could."""
    base = new_path(spark, "quarantine")
    _land(tables.event_lines(spark, sf_dir), "events", f"{base}/landed")
    _land(tables.page_lines(spark, sf_dir), "notes", f"{base}/landed")
    regions = tables.table(spark, sf_dir, "region")
    tables.land(regions.select(
        F.concat(F.lit("2015022000000"), F.col("r_regionkey").cast("string"), F.lit(".gkg.csv.zip")).alias("name"),
        F.col("r_name").cast("binary").alias("content")), f"{base}/landed")
    ledger.start_ledger_ingest(spark, f"{base}/landed", f"{base}/stored", f"{base}/progress").awaitTermination()
    return ledger.load_raw(spark, f"{base}/stored").select("dataset", "line", "error")


def timed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger has after an ingest on a timer that removes what it has taken, and what is left."""
    base = new_path(spark, "timed")
    # At once: a kind alone may be one task.
    with ThreadPoolExecutor(len(tables.LINES)) as pool:
        landed = [pool.submit(_land, lines(spark, sf_dir), kind, f"{base}/landed") for kind, lines in tables.LINES.items()]
    for kind in landed:
        kind.result()
    query = ledger.start_ledger_ingest(
        spark, f"{base}/landed", f"{base}/stored", f"{base}/progress", every="1 second", files_per_batch=5, clean=True)
    try:
        while query.isActive and not archives.list_archives(spark, f"{base}/landed").isEmpty():
            query.awaitTermination(1)
    finally:
        query.stop()
    left = archives.list_archives(spark, f"{base}/landed").groupBy("dataset").agg(F.count("*").alias("left"))
    taken = ledger.load_ledger(spark, f"{base}/stored").groupBy("dataset").agg(
        F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.count("error").alias("errors"))
    return taken.join(left, "dataset", "left").select("dataset", "rows", "bad", "errors", F.coalesce("left", F.lit(0)).alias("left"))


def replaced_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are not UTF-8, read from archives as streams, and whether bytes were replaced."""
    base = new_path(spark, "replaced")
    written = tables.archives(tables.text_lines(spark, sf_dir), "gkg", f"{base}/landed", encoding="latin-1")
    written.write.format("noop").mode("overwrite").save()
    return archives.stream_lines(archives.list_archives(spark, f"{base}/landed")).select("line", "replaced")


# Previews and scenes ---------------------------------------------------------

def preview_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = tables.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props"
    )
    return preview.preview(shown, "event_id", 2)


def scene_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.scene_search(tables.scenes(spark, sf_dir), *POINT, *DAYS)


def scenes_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scenes.scenes_at(tables.scenes(spark, sf_dir), *POINT)
    return scenes.acquired_between(at, *DAYS)


def scenes_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points, with all scenes over them; some scenes lie over the date line."""
    return scenes.scenes_of_points(
        tables.points(spark, sf_dir), tables.scenes_over_date_line(spark, sf_dir), ["point_id"], ["scene_id"])


def scene_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.scene_bands(tables.pixels(spark, sf_dir), "pixel_id")


def band_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.band_composites(tables.pixels(spark, sf_dir), "pixel_id")


QUERIES = {
    q.__name__: q
    for q in (
        cooc_weighted, cooc_counts, cooc_undirected, cooc_themes, cooc_themes_named, cooc_total,
        cooc_top_k, cooc_pairs, cooc_sql_function, cooc_sql_names, cooc_sql_pairs, entity_rank, alltime_pairs, multi_entity_filter, split_items,
        entity_names, top_themes, top_persons, top_organizations, top_locations,
        themes_with_empty, top_values_raw, rank_values, master_projection, day_slice,
        record_times, view_rows, daily_report, stored_json, event_mentions, records_with_attributes, url_extract, manifest_fields,
        latest_files, route_dataset, new_files, backfill_files, typed_records, typed_events, typed_mentions,
        typed_files, flat_files, flat_day, unzipped_lines, stream_ingest, ingest_late_files, timed_ingest, quarantine_rows, replaced_bytes, preview_transpose, scene_search,
        scenes_found, scenes_of_points, scene_bands, band_composite,
    )
}

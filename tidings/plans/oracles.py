"""SQL for DuckDB that gives the rows of each registered query."""

from __future__ import annotations

from tidings.plans.queries import DAY, DAYS, EVENT_DAYS, LATEST, MENTION_DAYS, POINT, STEPS, TOP
from tidings.plans.tables import FIRST_STAMP, PATTERNS

# Fixed values, written out once more so that the SQL does not follow the code it checks: bands of
# each combination, the display range, the address in a manifest line, and the columns of the three
# datasets in the order of the files with their types (V text, I integer, B bigint, D double).
COMBINATIONS = {
    "vegetation": (5, 4, 3), "natural_color": (4, 3, 2), "agriculture": (6, 5, 2),
    "land_water": (5, 6, 4), "urban": (7, 6, 4), "atmospheric": (7, 5, 4),
}
DISPLAY_MAX = 0.3
MANIFEST_URL_PATTERN = r"(https?://[^\s]+)"
RECORD_FIELDS = """
    V GKGRECORDID, B DATE, I SourceCollectionIdentifier, V SourceCommonName, V DocumentIdentifier,
    V Counts, V V2Counts, V Themes, V V2Themes, V Locations, V V2Locations, V Persons, V V2Persons,
    V Organizations, V V2Organizations, V V2Tone, V Dates, V GCAM, V SharingImage,
    V RelatedImages, V SocialImageEmbeds, V SocialVideoEmbeds, V Quotations, V AllNames, V Amounts,
    V TranslationInfo, V Extras"""
EVENT_FIELDS = """
    B GLOBALEVENTID, I SQLDATE, I MonthYear, I Year, D FractionDate, V Actor1Code, V Actor1Name,
    V Actor1CountryCode, V Actor1KnownGroupCode, V Actor1EthnicCode, V Actor1Religion1Code,
    V Actor1Religion2Code, V Actor1Type1Code, V Actor1Type2Code, V Actor1Type3Code, V Actor2Code,
    V Actor2Name, V Actor2CountryCode, V Actor2KnownGroupCode, V Actor2EthnicCode,
    V Actor2Religion1Code, V Actor2Religion2Code, V Actor2Type1Code, V Actor2Type2Code,
    V Actor2Type3Code, I IsRootEvent, V EventCode, V EventBaseCode, V EventRootCode, I QuadClass,
    D GoldsteinScale, I NumMentions, I NumSources, I NumArticles, D AvgTone, I Actor1Geo_Type,
    V Actor1Geo_FullName, V Actor1Geo_CountryCode, V Actor1Geo_ADM1Code, V Actor1Geo_ADM2Code,
    D Actor1Geo_Lat, D Actor1Geo_Long, V Actor1Geo_FeatureID, I Actor2Geo_Type,
    V Actor2Geo_FullName, V Actor2Geo_CountryCode, V Actor2Geo_ADM1Code, V Actor2Geo_ADM2Code,
    D Actor2Geo_Lat, D Actor2Geo_Long, V Actor2Geo_FeatureID, I ActionGeo_Type,
    V ActionGeo_FullName, V ActionGeo_CountryCode, V ActionGeo_ADM1Code, V ActionGeo_ADM2Code,
    D ActionGeo_Lat, D ActionGeo_Long, V ActionGeo_FeatureID, B DATEADDED, V SOURCEURL"""
MENTION_FIELDS = """
    B GLOBALEVENTID, B EventTimeDate, B MentionTimeDate, I MentionType, V MentionSourceName,
    V MentionIdentifier, I SentenceID, I Actor1CharOffset, I Actor2CharOffset, I ActionCharOffset,
    I InRawText, I Confidence, I MentionDocLen, D MentionDocTone, V MentionDocTranslationInfo,
    V Extras"""

# Fixed value: addresses as a host of dot-separated labels and an optional rest.
URL_BY_LABELS = (
    r"(http|ftp|https)(://)([\w_-]+(?:(?:\.[\w_-]+)+))"
    r"([\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?"
)


def _found(column: str) -> str:
    pattern, group = PATTERNS[column]
    pattern = pattern.replace("\n", "\\n")
    return f"regexp_extract_all(text, '{pattern}', {group})"


def _names(column: str) -> str:
    """Rows ``(k, nm, pos)``: record, name and position."""
    return f"""
    SELECT doc_id AS k, unnest(found) AS nm, unnest(range(len(found))) AS pos
    FROM (SELECT doc_id, {_found(column)} AS found FROM documents)"""


def _pairs(column: str) -> str:
    """CTEs ending in ``counts(name_a, name_b, count)`` over multi-entity records."""
    return _pairs_of(_names(column), at_least=2)


def _pairs_of(names: str, at_least: int) -> str:
    return f"""
    WITH x AS ({names}),
    g AS (SELECT k FROM x GROUP BY k HAVING count(*) >= {at_least}),
    m AS (SELECT k, nm, count(*) AS n FROM x JOIN g USING (k) GROUP BY k, nm),
    counts AS (
        SELECT a.nm AS name_a, b.nm AS name_b, cast(sum(a.n * b.n) AS BIGINT) AS count
        FROM m a JOIN m b USING (k) GROUP BY a.nm, b.nm)"""


_THEMES = f"SELECT k, upper(nm) AS nm FROM ({_names('Themes')})"
# The separator that closes a list makes one more item of it.
_THEMES_CLOSED = f"{_THEMES} UNION ALL SELECT DISTINCT k, '' FROM ({_names('Themes')})"

_WEIGHTED = """
    SELECT row_number() OVER (ORDER BY count DESC, name_a, name_b) AS rn, name_a, name_b, count,
           cast(count AS DOUBLE) / cast(sum(count) OVER () AS DOUBLE) AS weight
    FROM counts"""

_STAMP = f"""cast(strftime(TIMESTAMP '{FIRST_STAMP}' + to_minutes(15 * doc_id),
                  '%Y%m%d%H%M%S') AS BIGINT)"""


def _joined(column: str, each: str = "x", separator: str = ";") -> str:
    items = f"list_transform({_found(column)}, lambda x, i: {each})"
    return f"nullif(array_to_string({items}, '{separator}'), '')"


_RECORDS = f"""
    SELECT cast(doc_id AS VARCHAR) AS GKGRECORDID, {_STAMP} AS DATE,
           {_joined("AllNames", "x || ',' || (i - 1)")} AS AllNames,
           {_joined("Persons")} AS Persons, {_joined("Organizations")} AS Organizations,
           {_joined("Themes", "upper(x) || ';'", "")} AS Themes,
           {_joined("Locations")} AS Locations
    FROM documents"""


_FLAT = f"""
    SELECT GKGRECORDID, DATE, cast(nullif(cast(GKGRECORDID AS BIGINT) % 7, 0) AS INTEGER) AS SourceCollectionIdentifier,
           AllNames, CASE WHEN DATE // 1000000 % 3 <> 2 THEN Locations END AS Locations,
           cast(DATE // 1000000 AS INTEGER) AS ds
    FROM ({_RECORDS})"""


def _top(column: str, name: str = "nm") -> str:
    return f"""SELECT {name} AS {column}, count(*) AS count
    FROM ({_names(column)}) GROUP BY 1"""


_KIND = """CASE event_type WHEN 'click' THEN 'gkg.csv' WHEN 'view' THEN 'export.CSV'
    WHEN 'error' THEN 'mentions.CSV' ELSE event_type || '.csv' END"""
_DATASET = """CASE event_type WHEN 'click' THEN 'gkg' WHEN 'view' THEN 'events'
    WHEN 'error' THEN 'mentions' ELSE 'other' END"""
_FILE = f"strftime(ts, '%Y%m%d%H%M%S') || '.' || {_KIND} || '.zip'"

_EVENT_FIELDS = """event_id AS GLOBALEVENTID, event_type AS EventCode, value AS AvgTone,
    props AS SOURCEURL"""


def _fields(listed: str, key: str, **known: str) -> str:
    """Every column of a dataset: the known ones, and numbers made from key and place."""
    types = {"V": "VARCHAR", "I": "INTEGER", "B": "BIGINT", "D": "DOUBLE"}
    cells = []
    for place, field in enumerate(listed.split(",")):
        kind, name = field.split()
        value = known.get(name, f"cast({key} AS BIGINT) % 1000 * 100 + {place}")
        cells.append(f"cast({value} AS {types[kind]}) AS {name}")
    return ", ".join(cells)


_RECORD_LINES = _fields(
    RECORD_FIELDS, "GKGRECORDID",
    **{c: c for c in ("GKGRECORDID", "DATE", "Themes", "Locations", "Persons", "Organizations",
                      "AllNames")})
_EVENT_LINES = _fields(
    EVENT_FIELDS, "event_id", GLOBALEVENTID="event_id", SQLDATE="strftime(ts, '%Y%m%d')",
    MonthYear="strftime(ts, '%Y%m')", Year="year(ts)", Actor1Code="user_id",
    EventCode="event_type", AvgTone="value", DATEADDED="strftime(ts, '%Y%m%d%H%M%S')",
    SOURCEURL="props")
_MENTION_LINES = _fields(
    MENTION_FIELDS, "l_orderkey", GLOBALEVENTID="l_orderkey",
    MentionTimeDate="strftime(l_shipdate, '%Y%m%d%H%M%S')", MentionType="l_linenumber",
    MentionSourceName="l_returnflag", MentionIdentifier="l_partkey",
    Confidence="trunc(l_quantity)", MentionDocTone="l_discount")

_SCENES = """
    SELECT event_id AS scene_id,
           cast(user_id % 36 * 10 - 180 AS DOUBLE) AS xmin,
           cast(event_id % 18 * 10 - 90 AS DOUBLE) AS ymin,
           cast(user_id % 36 * 10 - 170 AS DOUBLE) AS xmax,
           cast(event_id % 18 * 10 - 80 AS DOUBLE) AS ymax,
           cast(ts AS DATE) AS acquired, value AS cloud_cover
    FROM events"""
_SCENES_FOUND = f"""
    SELECT * FROM ({_SCENES})
    WHERE {POINT[0]} BETWEEN xmin AND xmax AND {POINT[1]} BETWEEN ymin AND ymax
      AND acquired >= DATE '{DAYS[0]}' AND acquired < DATE '{DAYS[1]}'"""


def _preview() -> str:
    rows = []
    for column in ("user_id", "event_type", "value", "props"):
        cells = ", ".join(
            f"""max(cast({column} AS VARCHAR)) FILTER (event_id = {n}) AS "{n}" """ for n in (0, 1)
        )
        rows.append(f"""SELECT '{column}' AS "column", {cells} FROM events""")
    return " UNION ALL ".join(rows)


def _composite() -> str:
    def colour(band: int) -> str:
        share = f"cast(embedding[{band}] AS DOUBLE) / cast({DISPLAY_MAX} AS DOUBLE)"
        return f"greatest(0e0, least(1e0, {share}))"

    return " UNION ALL ".join(
        f"""SELECT vec_id AS pixel_id, {colour(r)} AS red, {colour(g)} AS green,
                   {colour(b)} AS blue, '{name}' AS combination FROM embeddings"""
        for name, (r, g, b) in COMBINATIONS.items()
    )


def _view_rows() -> str:
    today = f"DATE >= {DAY}000000 AND DATE < {DAY + 1}000000"
    wanted = {"records": "true", "master": "true", "multi_entity": "AllNames LIKE '%;%'"}
    return " UNION ALL ".join(
        f"""SELECT '{view}{suffix}' AS view, count(*) AS rows
            FROM ({_RECORDS}) WHERE {condition} AND {days}"""
        for view, condition in wanted.items()
        for suffix, days in (("", "true"), ("_today", today))
    )


def _shown(days: dict[str, int]) -> str:
    """Fields of the three datasets as ingest stores them; ``days`` of the files, where not the first."""
    parts = [
        ("gkg", "doc_id", "AllNames", "Locations", "doc_id % 1000 * 100 + 2",
         f"(SELECT documents.doc_id, r.* FROM ({_RECORDS}) r JOIN documents ON cast(doc_id AS VARCHAR) = GKGRECORDID)"),
        ("events", "event_id", "event_type", "props", "value", "events"),
        ("mentions", "l_orderkey", "l_returnflag", "cast(l_partkey AS VARCHAR)", "l_discount", "lineitem"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS dataset, cast({key} AS BIGINT) AS key, cast({days.get(kind, 20150218)} AS INTEGER) AS ds,
            {first} AS first, {second} AS second, cast({number} AS DOUBLE) AS number, cast(NULL AS VARCHAR) AS bad
            FROM {table}"""
        for kind, key, first, second, number, table in parts)


def _daily_report() -> str:
    parts = []
    day = f"strftime(TIMESTAMP '{FIRST_STAMP}' + to_minutes(15 * doc_id), '%Y%m%d') = '{DAY}'"
    for run, documents in (("all", "documents"), ("day", f"(SELECT * FROM documents WHERE {day}) documents")):
        pairs = f"({_pairs('AllNames')} {_WEIGHTED})".replace("FROM documents", f"FROM {documents}")
        parts.append(f"""SELECT '{run}' AS run, 'cooccurences' AS result, rn, name_a, name_b, count, weight
            FROM {pairs}""")
        for result, column, name in (("themes", "Themes", "upper(nm)"), ("people", "Persons", "nm"),
                                     ("organizations", "Organizations", "nm")):
            counts = f"({_top(column, name)})".replace("FROM documents", f"FROM {documents}")
            parts.append(f"""SELECT '{run}', '{result}', NULL, {column}, NULL, count, NULL FROM {counts}""")
    return " UNION ALL ".join(parts)


def _entity_rank() -> str:
    """Every step written out; ranks are whole parts of 10**15."""
    steps = [f"""
    r0 AS MATERIALIZED (SELECT nm, {10**15} // (SELECT count(*) FROM node) AS r FROM node)"""]
    for i in range(STEPS):
        steps.append(f"""
    r{i + 1} AS MATERIALIZED (
        SELECT node.nm, base + coalesce(given, 0) * 85 // 100 AS r
        FROM node LEFT JOIN (
            SELECT dst, sum(cast(floor(cast(r AS DOUBLE) * share) AS BIGINT)) AS given
            FROM r{i} JOIN link ON src = nm GROUP BY dst) ON dst = node.nm
        CROSS JOIN (
            SELECT (15 * {10**15}::HUGEINT + 85 * coalesce(sum(r) FILTER (links = 0), 0))
                   // (100 * count(*)) AS base
            FROM r{i} JOIN node USING (nm)))""")
    return _pairs("AllNames") + f""",
    every AS (SELECT name_a AS src, name_b AS dst, count FROM counts WHERE name_a <> name_b),
    link AS MATERIALIZED (
        SELECT src, dst, cast(count AS DOUBLE) / cast(sum(count) OVER (PARTITION BY src) AS DOUBLE) AS share
        FROM every),
    node AS MATERIALIZED (
        SELECT nm, coalesce(n, 0) AS links FROM (SELECT DISTINCT nm FROM x)
        LEFT JOIN (SELECT src AS nm, count(*) AS n FROM link GROUP BY src) USING (nm)),
    {",".join(steps)}
    SELECT row_number() OVER (ORDER BY r DESC, nm) AS rn, nm AS name, links,
           cast(r AS DOUBLE) / 1e15 AS rank
    FROM r{STEPS} JOIN node USING (nm)"""


ORACLES = {
    "cooc_weighted": _pairs("AllNames") + _WEIGHTED,
    "cooc_counts": _pairs("AllNames") + " SELECT * FROM counts",
    "cooc_undirected": _pairs("AllNames") + " SELECT * FROM counts WHERE name_a < name_b",
    "cooc_themes": _pairs_of(_THEMES_CLOSED, at_least=2) + " SELECT * FROM counts",
    # A closed list of one name passes as a list of several.
    "cooc_themes_named": _pairs_of(_THEMES, at_least=1) + " SELECT * FROM counts",
    "cooc_total": _pairs("AllNames") + " SELECT cast(sum(count) AS BIGINT) AS total FROM counts",
    "cooc_top_k": _pairs("AllNames") + f" SELECT * FROM ({_WEIGHTED}) WHERE rn <= {TOP}",
    "cooc_pairs": f"""
        WITH x AS ({_names("AllNames")}),
        g AS (SELECT k FROM x GROUP BY k HAVING count(*) > 1),
        m AS (SELECT k, nm, count(*) AS n FROM x JOIN g USING (k) GROUP BY k, nm)
        SELECT cast(k AS VARCHAR) AS GKGRECORDID, a.nm AS name_a, b.nm AS name_b,
               a.n * b.n AS count
        FROM m a JOIN m b USING (k)""",
    "cooc_sql_function": _pairs("AllNames") + " SELECT * FROM counts",
    "cooc_sql_pairs": _pairs("AllNames") + " SELECT * FROM counts",
    "cooc_sql_names": _pairs("AllNames") + " SELECT * FROM counts",
    "entity_rank": _entity_rank(),
    "alltime_pairs": _pairs("AllNames") + _WEIGHTED,
    "records_with_attributes": """
        WITH a AS (
            SELECT user_id AS k, event_type AS state, event_id AS number,
                   TIMESTAMP '1995-01-01' + to_days(cast(event_id * 37 % 2400 AS INTEGER)) AS since,
                   CASE WHEN event_type <> 'signup' THEN TIMESTAMP '1995-01-01'
                       + to_days(cast(event_id * 37 % 2400 + user_id % 5 * 100 AS INTEGER)) END AS until
            FROM events)
        SELECT o_orderkey, state, number
        FROM (SELECT o_orderkey, state, number, row_number() OVER (
                  PARTITION BY o_orderkey
                  ORDER BY since DESC, coalesce(until, TIMESTAMP '9999-01-01') DESC, state DESC, number DESC) AS place
              FROM orders LEFT JOIN a ON k = o_custkey AND since <= o_orderdate
                  AND (until IS NULL OR o_orderdate < until))
        WHERE place = 1""",
    "multi_entity_filter": f"""
        SELECT AllNames FROM ({_RECORDS}) WHERE AllNames LIKE '%;%'""",
    "split_items": f"""
        SELECT cast(k AS VARCHAR) AS GKGRECORDID, nm || ',' || pos AS item
        FROM ({_names("AllNames")})""",
    "entity_names": f"""
        SELECT cast(k AS VARCHAR) AS GKGRECORDID, nm AS name FROM ({_names("AllNames")})""",
    "top_themes": _top("Themes", "upper(nm)"),
    "top_persons": _top("Persons"),
    "top_organizations": _top("Organizations"),
    "top_locations": _top("Locations"),
    "themes_with_empty": f"""
        SELECT nm AS Themes, count(*) AS count FROM ({_THEMES_CLOSED}) GROUP BY nm""",
    "top_values_raw": f"""
        SELECT Organizations, count(*) AS count FROM ({_RECORDS}) GROUP BY Organizations""",
    "rank_values": """
        WITH w AS (SELECT unnest(regexp_split_to_array(text, '[\\s;]+')) AS Words FROM documents),
        c AS (SELECT Words, count(*) AS count FROM w WHERE Words <> '' GROUP BY Words)
        SELECT Words, count, row_number() OVER (ORDER BY count DESC, Words) AS rn FROM c""",
    "master_projection": f"SELECT * REPLACE (cast(DATE AS VARCHAR) AS DATE) FROM ({_RECORDS})",
    "day_slice": f"""
        SELECT GKGRECORDID, DATE, AllNames, cast({DAY} AS INTEGER) AS ds FROM ({_RECORDS})
        WHERE DATE >= {DAY}000000 AND DATE < {DAY + 1}000000""",
    "record_times": f"""
        SELECT cast(doc_id AS VARCHAR) AS GKGRECORDID, strftime(time, '%Y%m%d') AS day,
               strftime(time, '%Y-%m-%d %H:%M:%S') AS time
        FROM (SELECT doc_id, TIMESTAMP '{FIRST_STAMP}' + to_minutes(15 * doc_id) AS time
              FROM documents)""",
    "view_rows": _view_rows(),
    "daily_report": _daily_report(),
    "stored_json": _top("Organizations"),
    "event_mentions": f"""
        SELECT event_id AS GLOBALEVENTID, cast(strftime(ts, '%Y%m%d') AS INTEGER) AS ds,
               event_type AS EventCode, value AS AvgTone, mention_MentionTimeDate,
               mention_MentionType, mention_Confidence
        FROM events LEFT JOIN (
            SELECT l_orderkey, cast(strftime(l_shipdate, '%Y%m%d%H%M%S') AS BIGINT) AS mention_MentionTimeDate,
                   cast(l_linenumber AS INTEGER) AS mention_MentionType,
                   cast(trunc(l_quantity) AS INTEGER) AS mention_Confidence
            FROM lineitem
            WHERE strftime(l_shipdate, '%Y%m%d') BETWEEN '{MENTION_DAYS[0]}' AND '{MENTION_DAYS[1]}'
        ) ON l_orderkey = event_id
        WHERE strftime(ts, '%Y%m%d') BETWEEN '{EVENT_DAYS[0]}' AND '{EVENT_DAYS[1]}'""",
    "url_extract": f"""
        SELECT url, split_part(url, '/', -1) AS file_name
        FROM (SELECT unnest(regexp_extract_all(url || ' ' || html, '{URL_BY_LABELS}', 0)) AS url
              FROM pages)""",
    "manifest_fields": f"""
        SELECT user_id + 1000 AS size, md5(cast(event_id AS VARCHAR)) AS checksum,
               regexp_extract('http://data.example.org/v2/' || {_FILE},
                              '{MANIFEST_URL_PATTERN}', 1) AS url,
               {_FILE} AS file_name, strftime(ts, '%Y%m%d%H%M%S') AS stamp,
               {_DATASET} AS dataset
        FROM events""",
    "latest_files": f"""
        SELECT strftime(ts, '%Y%m%d%H%M%S') AS stamp, {_FILE} AS file_name, {_DATASET} AS dataset
        FROM events ORDER BY 1 DESC, 2 DESC LIMIT {LATEST}""",
    "route_dataset": f"SELECT {_DATASET} AS dataset, count(*) AS files FROM events GROUP BY 1",
    "new_files": """
        SELECT 'batch-' || event_id || '.gkg.csv.zip' AS source_file FROM events
        WHERE NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = event_id)""",
    "backfill_files": f"""
        SELECT user_id + 1000 AS size, md5(cast(event_id AS VARCHAR)) AS checksum,
               'http://data.example.org/v2/' || {_FILE} AS url, {_FILE} AS file_name,
               strftime(ts, '%Y%m%d%H%M%S') AS stamp, {_DATASET} AS dataset
        FROM events WHERE event_type NOT IN ('click', 'view')""",
    "typed_records": f"""
        SELECT {_RECORD_LINES}, cast(NULL AS VARCHAR) AS bad FROM ({_RECORDS})""",
    "typed_events": f"SELECT {_EVENT_LINES}, cast(NULL AS VARCHAR) AS bad FROM events",
    "typed_mentions": f"SELECT {_MENTION_LINES}, cast(NULL AS VARCHAR) AS bad FROM lineitem",
    "typed_files": f"SELECT {_MENTION_LINES} FROM lineitem",
    "flat_files": f"SELECT * FROM ({_FLAT})",
    "flat_day": f"SELECT * FROM ({_FLAT}) WHERE ds = {DAY}",
    "unzipped_lines": f"""
        SELECT 'events' AS dataset, cast(NULL AS VARCHAR) AS error, {_EVENT_FIELDS} FROM events""",
    "stream_ingest": _shown({}),
    "ingest_late_files": _shown({"gkg": 20140101}),
    "timed_ingest": " UNION ALL ".join(
        f"""SELECT '{kind}' AS dataset, count(*) AS rows, cast(0 AS BIGINT) AS bad, cast(0 AS BIGINT) AS errors,
            cast(0 AS BIGINT) AS "left" FROM {table}"""
        for kind, table in (("gkg", "documents"), ("events", "events"), ("mentions", "lineitem"))),
    "replaced_bytes": r"""
        SELECT regexp_replace(regexp_replace(line, '[\x{80}-\x{FF}]', chr(65533), 'g'), '[\x{100}-\x{FFFC}\x{FFFE}-\x{10FFFF}]', '?', 'g') AS line,
               regexp_matches(line, '[\x{80}-\x{FF}]') AS replaced
        FROM (SELECT doc_id || chr(9) || regexp_replace(coalesce(text, ''), '[\n\r]+', ' ', 'g') AS line FROM documents)""",
    "quarantine_rows": """
        SELECT 'other' AS dataset, page_id || chr(9) || url AS line, cast(NULL AS VARCHAR) AS error FROM pages
        UNION ALL SELECT 'gkg', NULL, 'BadZipFile: File is not a zip file' FROM region""",
    "preview_transpose": _preview(),
    "scene_search": _SCENES_FOUND + " ORDER BY cloud_cover, scene_id LIMIT 1",
    "scenes_found": _SCENES_FOUND,
    "scenes_of_points": f"""
        WITH s AS (
            SELECT scene_id, xmin + 5 AS xmin, CASE WHEN xmax + 5 > 180 THEN xmax - 355 ELSE xmax + 5 END AS xmax,
                   ymin, ymax
            FROM ({_SCENES})),
        p AS (
            SELECT c_custkey AS point_id, cast(c_custkey * 7919 % 3601 AS DOUBLE) / 10e0 - 180e0 AS lon,
                   cast(c_custkey * 104729 % 1801 AS DOUBLE) / 10e0 - 90e0 AS lat
            FROM customer)
        SELECT point_id, scene_id FROM p JOIN s ON lat BETWEEN ymin AND ymax
            AND CASE WHEN xmin <= xmax THEN lon BETWEEN xmin AND xmax ELSE lon >= xmin OR lon <= xmax END""",
    "scene_bands": """
        SELECT vec_id AS pixel_id, unnest(range(1, len(embedding) + 1)) AS band,
               unnest(embedding) AS value
        FROM embeddings""",
    "band_composite": _composite(),
}

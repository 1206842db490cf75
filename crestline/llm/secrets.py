"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Spans of three base kinds are found by pattern in whole texts.  Every candidate value, which is
what a base span holds as well as any other long run of letters and digits, is hashed and
counted over the corpus by distinct repositories and distinct owners.  A value seen with few of
both is specific to its owner and looks live; one seen with many owners, or in many repositories of
one, is a copied example.  Runs that no
base pattern covers and that look live are added as spans of the kind ``owned``; base spans stay,
and are counted as live or copied.

Positions come from lengths: a text is the pieces between the matches and the matches in turn,
so the start of a match is the length of all that stands before it.  Texts without the letters
a pattern needs never meet the pattern.

Only hashes with positions are shuffled, never texts.  A value that fills a third of all rows
is counted by partial aggregation, and its join back is split by adaptive execution.

Defined cases: null text is empty, empty text has no spans and the hash of the empty string;
rows repeated with one id are kept apart; a null repository or owner counts as one of its own.

Texts are read whole, however long; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import materialize, read_table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
LEAST = {"assign": 6, "access": 20, "hex": 24}
MAX_OWNERS = 2
MAX_REPOSITORIES = 10
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_SPAN = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Start, end and value of every match whose value is long enough."""
    regex = F.lit(pattern)
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, 0).alias("hit"),
        F.regexp_extract_all(text, regex, group).alias("value"),
    )
    empty = F.expr(f"cast(array() as {_SPAN})")
    begun = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"]).cast("long")
        end = start + F.length(x["hit"]).cast("long")
        span = F.struct(
            start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), x["value"].alias("value")
        )
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(keep, F.concat(done["out"], F.array(span))).otherwise(done["out"]).alias("out"),
        )

    return F.aggregate(found, begun, step, lambda done: done["out"]).cast(_SPAN)


def _ordered(spans: Column) -> Column:
    return F.array_sort(spans)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(text, ",")


def scan(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", repository: str = "doc_id",
    owner: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: key, counts of the base kinds, base hash, all spans, ownership counts.

    ``most_owners`` and ``most_repositories`` are the largest counts of any of its values.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    small = F.lower(body)
    none = F.expr(f"cast(array() as {_SPAN})")
    named = small.contains(NAMES[0])
    for name in NAMES[1:]:
        named = named | small.contains(name)
    has_hex = body.rlike("[0-9a-f]{%d}" % LEAST["hex"])
    has_run = body.rlike(RUN)

    def on(condition: Column, spans: Column) -> Column:
        return F.when(condition, spans).otherwise(none)

    base = F.concat(
        on(named, _spans(body, ASSIGN, "assign", 1, LEAST["assign"])),
        on(body.contains("AKIA"), _spans(body, ACCESS, "access", 0, LEAST["access"])),
        on(has_hex, _spans(body, HEX, "hex", 0, LEAST["hex"])),
    )
    found = docs.select(
        F.col(key).alias("key"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        base.alias("base"), on(has_run, _spans(body, RUN, "owned")).alias("run"),
    )
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    free = F.filter(
        "run",
        lambda r: mixed(r["value"]) & ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
    )
    # Values leave the table as hashes here.
    hashed = lambda spans: F.transform(spans, lambda s: s.withField("value", F.sha2(s["value"], 256)))
    found = materialize(
        found.select(
            F.monotonically_increasing_id().alias("row"), "key", "repository", "owner",
            hashed(_ordered(F.col("base"))).alias("base"), hashed(free).alias("free"),
        ),
        "secret-spans",
    )
    each = found.where((F.size("base") > 0) | (F.size("free") > 0)).select(
        "row", "repository", "owner", F.explode(F.concat("base", "free")).alias("span")
    )
    counted = (
        each.select(F.col("span.value").alias("value"), F.coalesce("repository", F.lit("\0")).alias("r"), F.coalesce("owner", F.lit("\0")).alias("o"))
        .distinct()
        .groupBy("value")
        .agg(F.count_distinct("r").alias("repositories"), F.count_distinct("o").alias("owners"))
    )
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    is_added = F.col("span.kind") == KINDS.index("owned")
    judged = (
        each.select("row", "span", F.col("span.value").alias("value"))
        .join(counted, "value")
        .groupBy("row")
        .agg(
            F.collect_list(F.when(is_added & live, F.col("span"))).alias("added"),
            F.count(F.when(~is_added & live, 1)).alias("n_live"),
            F.count(F.when(~is_added & ~live, 1)).alias("n_copied"),
            F.max("owners").alias("most_owners"),
            F.max("repositories").alias("most_repositories"),
        )
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    added = F.coalesce("added", none)
    return found.join(judged, "row", "left").select(
        "key",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(_ordered(F.concat("base", added))).alias("spans"),
        F.size(added).cast("long").alias("n_owned"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce("most_owners", F.lit(0)).cast("long").alias("most_owners"),
        F.coalesce("most_repositories", F.lit(0)).cast("long").alias("most_repositories"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return scan(docs).withColumnRenamed("key", "doc_id")


def _sql_spans(pattern: str, kind: int, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, g[1:i] AS before, i, h[i] AS hit, v[i] AS value, h[1:i-1] AS earlier, {kind} AS kind
  FROM (SELECT doc_id, regexp_split_to_array(body, '{quoted}') AS g,
               regexp_extract_all(body, '{quoted}', 0) AS h, regexp_extract_all(body, '{quoted}', {group}) AS v
        FROM t) x, LATERAL (SELECT unnest(range(1, len(h) + 1)) AS i) n
  WHERE len(v[i]) >= {least}"""


SECRETS_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(source, chr(0)) AS owner FROM documents),
raw AS (
  {_sql_spans(ASSIGN, 0, 1, LEAST["assign"])}
  UNION ALL {_sql_spans(ACCESS, 1, 0, LEAST["access"])}
  UNION ALL {_sql_spans(HEX, 2, 0, LEAST["hex"])}
  UNION ALL {_sql_spans(RUN, 3, 0, 0)}
), placed AS (
  SELECT doc_id, kind, value, s AS start, s + len(hit) AS stop FROM (
    SELECT *, coalesce(list_sum(list_transform(before, lambda x: len(x))), 0)
            + coalesce(list_sum(list_transform(earlier, lambda x: len(x))), 0) AS s FROM raw)
), base AS (SELECT * FROM placed WHERE kind < 3),
free AS (
  SELECT * FROM placed r WHERE kind = 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start < r.stop AND r.start < b.stop)
), spans AS (SELECT * FROM base UNION ALL SELECT * FROM free),
owned AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), chr(0))) AS repositories,
         owners <= {MAX_OWNERS} AND repositories <= {MAX_REPOSITORIES} AS live
  FROM spans JOIN t USING (doc_id) GROUP BY value
), judged AS (
  SELECT doc_id, kind, start, stop, live, owners, repositories,
         ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said
  FROM spans JOIN owned USING (value)
), per AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
         string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3 OR live) AS spans,
         count(*) FILTER (kind = 3 AND live) AS o, count(*) FILTER (kind < 3 AND live) AS l,
         count(*) FILTER (kind < 3 AND NOT live) AS c, max(owners) AS most_o, max(repositories) AS most_r
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(o, 0) AS n_owned, coalesce(l, 0) AS n_live, coalesce(c, 0) AS n_copied,
       coalesce(most_o, 0) AS most_owners, coalesce(most_r, 0) AS most_repositories
FROM t LEFT JOIN per USING (doc_id)"""

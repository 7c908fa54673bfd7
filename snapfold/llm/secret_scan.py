"""Secret scan with multipart credential linking, in DataFrame operations alone.

Base spans are found by pattern and length alone.  Weaker candidates (a login, an opaque token, an
endpoint) are far too common to be reported alone; one is reported if the parts that complete a
credential stand near it.  Spans are intervals over the text's code points; the ones that complete each
other are found by an interval join: the text is cut into scopes of ``SCOPE`` code points, spans are
joined by the scopes they touch, and a candidate looks for a span of a role in its surroundings that shares no
character with it, so that no string completes itself.  A scope holds a bounded number of spans, as those of a
kind don't overlap.  No pair is emitted, and nothing but spans is shuffled.

Positions come from the gaps and the matches of a pattern: the text split at it, and all it matched.

Defined results: a null or empty text has no spans; texts are read whole; repeated rows get equal
results, each for itself; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.once import once
from ..session import saved, scratch_folder
from . import common

SCOPE = 200  # code points on either side of a candidate

# The patterns.  A span's kind is its place in KINDS, from 1.  Where a kind asks for a
# length, the pattern asks for it too if that finds the same: a run of one class that is too short holds
# no match.  Assignments and logins are matched first and measured then, as that consumes the short ones.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LOGIN = r"""(?i)(user|username|login|email|client_?id|account_?id|tenant_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)"""
OPAQUE = r"[A-Za-z0-9/+]{20,}"
ENDPOINT = r"""(https?|jdbc:[a-z]+|postgres|postgresql|mysql|redis|amqp|mongodb|s3)://[^\x20\x09-\x0D"'<>]+"""

KINDS = ("assign", "access", "hex", "login", "opaque", "endpoint")
#: What must stand near a weak kind: every role in one of the sets.
IDENTIFIER, SECRET, PLACE = "identifier", "secret", "place"
ROLES = {1: SECRET, 2: IDENTIFIER, 3: SECRET, 4: IDENTIFIER, 5: SECRET, 6: PLACE}
NEEDS = {4: ((SECRET,),), 5: ((IDENTIFIER,), (PLACE,)), 6: ((IDENTIFIER, SECRET),)}
BASE = 3


SPANS = "array<struct<start:int,kind:int,end:int>>"


def _matches(kind: int, pattern: str, accept=None) -> Column:
    """Spans of the leftmost non-overlapping matches, of those that ``accept`` takes if it is given.

    ``accept`` gets the match, or its second group where the pattern has two.
    """
    text, p = F.col("text"), F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(2)) if "(?i)" in pattern else found
    steps = F.zip_with(found, values, lambda m, v: F.struct(
        F.length(m).alias("size"), (accept(v) if accept else F.lit(True)).alias("taken")))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), steps, lambda g, s: F.struct(
        g.alias("gap"), s["size"].alias("size"), s["taken"].alias("taken")))

    def walk(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(step["taken"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(steps, begin, walk, lambda state: state["spans"])


def _mixed(m: Column) -> Column:
    """Both cases and a digit."""
    return m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]")


def candidates(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """(id, key, base, weak): the spans of every row, base ones and weak ones; the key names the text."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")

    def where(test: Column, spans: Column) -> Column:  # a plain test spares most rows the walk
        return F.when(test, spans).otherwise(F.array().cast(SPANS))

    rows = once(
        rows,
        assign=where(t.rlike(ASSIGN), _matches(1, ASSIGN, lambda v: F.length(v) >= 6)),
        access=where(t.contains("AKIA"), _matches(2, ACCESS)),
        hexes=where(t.rlike(HEX), _matches(3, HEX)),
        login=where(t.rlike(LOGIN), _matches(4, LOGIN, lambda v: F.length(v) >= 3)),
        opaque=where(t.rlike(OPAQUE), _matches(5, OPAQUE, _mixed)),
        endpoint=where(t.contains("://"), _matches(6, ENDPOINT)),
        key=F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")),
    )
    return rows.select("id", "key", F.concat("assign", "access", "hexes").alias("base"),
                       F.concat("login", "opaque", "endpoint").alias("weak"))


def _scopes(low: Column, high: Column) -> Column:
    """Numbers of the scopes that the code points from ``low`` to before ``high`` touch."""
    return F.explode(F.sequence(F.floor(F.greatest(low, F.lit(0)) / SCOPE), F.floor((high - 1) / SCOPE)))


def linked(rows: DataFrame, folder: str) -> DataFrame:
    """(key, strong): the weak spans of each text that stand near what completes them."""
    texts = rows.where(F.size("weak") > 0).select("key", "base", "weak").dropDuplicates(["key"])
    texts = saved(texts, f"{folder}/weak")
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k in sorted(ROLES)]), F.col("kind"))
    parts = texts.select("key", F.inline(F.concat("base", "weak"))).withColumn("role", role)
    roles = (IDENTIFIER, SECRET, PLACE)
    scopes = parts.withColumn("scope", _scopes(F.col("start"), F.col("end"))).groupBy("key", "scope").agg(
        *[F.collect_set(F.when(F.col("role") == r, F.struct("start", "end"))).alias(f"{r}_spans") for r in roles])
    scopes = saved(scopes, f"{folder}/scopes")
    low, high = F.col("start") - SCOPE, F.col("end") + SCOPE
    weak = texts.select("key", F.inline("weak")).withColumn("scope", _scopes(low, high)).join(scopes, ["key", "scope"])
    near = {r: F.exists(f"{r}_spans", lambda s: ((s["end"] <= F.col("start")) & (s["end"] > low))
                        | ((s["start"] >= F.col("end")) & (s["start"] < high))) for r in roles}
    found = weak.groupBy("key", "start", "kind", "end").agg(
        *[F.coalesce(F.max(near[r]), F.lit(False)).alias(r) for r in roles])
    complete = F.lit(False)
    for kind, sets in NEEDS.items():
        for needed in sets:
            test = F.col("kind") == kind
            for r in needed:
                test = test & F.col(r)
            complete = complete | test
    return found.where(complete).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("strong"))


def scan(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, base, spans): arrays of (start, kind, end) by start and kind; ``spans`` has the linked ones too."""
    folder = scratch_folder(docs.sparkSession, "secrets")
    rows = saved(candidates(docs, text, id_column), f"{folder}/rows")
    strong = saved(linked(rows, folder), f"{folder}/strong")
    found = rows.join(strong, "key", "left")
    extra = F.coalesce("strong", F.array().cast(SPANS))
    return found.select(F.col("id").alias(id_column), F.array_sort("base").alias("base"), F.array_sort(F.concat("base", extra)).alias("spans"))


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"], s["end"])), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{KINDS[k - 1]}") for k in range(1, BASE + 1)]
    return found.select("doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


def _sql_kind(kind: int, pattern: str, value: str) -> str:
    p = pattern.replace("'", "''")
    return (f"select doc_id, {kind} as kind, string_split_regex(text, '{p}') as g, regexp_extract_all(text, '{p}', 0) as f, "
            f"regexp_extract_all(text, '{p}', {2 if '(?i)' in pattern else 0}) as v from t where {value}")


OP5_SQL = f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
m as (
  {" union all ".join(_sql_kind(k, p, "true") for k, p in enumerate((ASSIGN, ACCESS, HEX, LOGIN, OPAQUE, ENDPOINT), 1))}
), r as (select doc_id, kind, g, f, v, unnest(range(1, len(f) + 1)) as i from m
), s as (
  select doc_id, kind, v[i] as value, f[i] as body,
    list_sum([len(x) for x in g[1:i]]) + coalesce(list_sum([len(x) for x in f[1:i - 1]]), 0) as start
  from r
), p as (
  select doc_id, kind, start::bigint as start, (start + len(body))::bigint as stop, ['x', 'secret', 'identifier', 'secret', 'identifier', 'secret', 'place'][kind + 1] as role
  from s where case kind when 1 then len(value) >= 6 when 4 then len(value) >= 3
    when 5 then regexp_matches(value, '[A-Z]') and regexp_matches(value, '[a-z]') and regexp_matches(value, '[0-9]') else true end
), n as (
  select w.doc_id, w.kind, w.start, w.stop, bool_or(o.role = 'identifier') as a, bool_or(o.role = 'secret') as b, bool_or(o.role = 'place') as c
  from p w join p o on o.doc_id = w.doc_id and o.stop > w.start - {SCOPE} and o.start < w.stop + {SCOPE}
    and (o.stop <= w.start or o.start >= w.stop)
  where w.kind > {BASE} group by all
), z as (
  select doc_id, kind, start, stop from p where kind <= {BASE} union all
  select doc_id, kind, start, stop from n where (kind = 4 and b) or (kind = 5 and (a or c)) or (kind = 6 and a and b)
), y as (
  select doc_id, kind, start, {list(KINDS)}[kind] || ':' || start || ':' || stop as span from z
), x as (
  select doc_id, count(*) filter (kind = 1) as n1, count(*) filter (kind = 2) as n2, count(*) filter (kind = 3) as n3,
    string_agg(span, ',' order by start, kind) filter (kind <= {BASE}) as base, string_agg(span, ',' order by start, kind) as spans
  from y group by 1
)
select t.doc_id, coalesce(n1, 0)::bigint as n_assign, coalesce(n2, 0)::bigint as n_access, coalesce(n3, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join x using (doc_id)
"""

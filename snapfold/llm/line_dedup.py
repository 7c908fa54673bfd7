"""Line dedup by a deletion-neighbourhood join, in DataFrame operations alone.

A line is its sequence of words.  Two lines are copies if their words are equal, or if both have at
least ``min_words`` words and one word inserted, deleted or replaced makes them equal.  A line goes if a
copy of it stands earlier in the corpus, by (document, line number); whether that copy goes itself
does not matter.  A document is its id and its text, the text named by a 128-bit hash: documents are in the
order of their ids, and different texts under one id, or without one, in the order of that hash.

Lines one edit apart have an equal variant: the lines without the edited word.  So every line emits its
own key and one for each word left out, and equal keys are joined.  Two steps keep this small and exact:

* Halves.  With one edit, either the first half of both lines or the last is equal.  Lines that share
  no half with another line emit nothing; of the others, only words in the half that may differ are
  left out.
* Least ranks in place of pairs.  All lines that leave out the same place to the same key are one
  replacement apart, and a line is one insertion from all that give its own key by leaving out a word.
  So the earliest copy of each is a minimum per key (and place), and no group is ever paired out.

The edit distance of each link is verified on the words.  Keys XOR a hash of each word with its place,
so leaving out a word takes the sums before and behind it; sums over blocks of words keep that from
growing with the square of a long line.

Defined results: null texts have no lines and stay null; lines without a word are never dropped; texts
and lines are read whole; rows equal in id and text are one document, get equal verdicts and all stay; a null
id comes before all others; an empty table gives no rows; extra columns are kept by ``dedup_lines`` and not
read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.once import once
from ..session import saved, scratch_folder
from . import common

MIN_WORDS = 8
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 32  # words whose hashes are summed at once
PLACE = ("doc", "t1", "t2", "line")  # where a line stands: the document's id, the hash of its text, the line's number


def text_hash(text: str) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def bodies_of(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """(doc, t1, t2, line, body) of every line."""
    t1, t2 = text_hash(text)
    rows = docs.select(F.col(id_column).alias("doc"), t1.alias("t1"), t2.alias("t2"), F.col(text).alias("body"))
    return rows.select("doc", "t1", "t2", F.posexplode(F.split("body", "\n")).alias("line", "body"))


def with_words(bodies: DataFrame) -> DataFrame:
    """(doc, t1, t2, line, words, h1, h2) of every line with a word; h1 and h2 name its content."""
    rows = once(bodies, words=F.split(F.btrim("body", F.lit(SPACES)), r"[\x20\x09-\x0D]+")).where("words[0] != ''")
    return rows.select(*PLACE, "words", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"))


def _halves() -> Column:
    """Keys of the first and the last half, as the longer or the only length and as the longer by one."""
    n, out = F.size("words"), []
    for late, short in ((True, n), (True, n - 1), (False, n), (False, n - 1)):
        cut = F.floor(short / 2).cast("int")
        part = F.slice("words", F.lit(1), cut) if late else F.slice("words", n - (short - cut) + 1, short - cut)
        out.append(F.struct(F.xxhash64(F.lit(late), short, part).alias("key"), F.lit(late).alias("late")))
    return F.array(*out)


def sift(lines: DataFrame, contents: DataFrame) -> DataFrame:
    """``lines`` whose (h1, h2) is in ``contents``, with the columns of both; few others are shuffled."""
    return common.likely(lines, contents, "h1").join(contents, ["h1", "h2"])


def _xor(parts: Column, field: str) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x[field]))


def variants(lines: DataFrame) -> DataFrame:
    """(h1, h2, doc, t1, t2, line, key, size, place): each line whole (place -1), and without one word.

    ``early`` and ``late`` say in which halves a word may be left out.
    """
    n = F.size("words")
    rows = once(lines, hashes=F.transform("words", lambda w, i: F.struct(
        F.xxhash64(w, i).alias("a"), F.xxhash64(w, i - 1).alias("b"))))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda k: F.slice("hashes", k * BLOCK + 1, F.lit(BLOCK)))
    rows = once(rows, blocks=blocks)
    sums = F.transform("blocks", lambda block: F.struct(_xor(block, "a").alias("a"), _xor(block, "b").alias("b")))
    rows = once(rows, sums=sums)
    # per block the sums before and behind it
    around = F.transform("sums", lambda _, k: F.struct(
        _xor(F.slice("sums", F.lit(1), k), "a").alias("a"), _xor(F.slice("sums", k + 2, F.size("sums")), "b").alias("b")))
    rows = once(rows, whole=_xor(F.col("sums"), "a"), around=around)
    rows = rows.select("h1", "h2", *PLACE, "early", "late", "whole", "around", n.alias("n"),
                       F.posexplode("blocks").alias("k", "block"))
    rows = once(rows, mine=F.element_at("around", F.col("k") + 1))
    left_out = F.transform("block", lambda _, i: F.struct(
        F.col("mine.a").bitwiseXOR(_xor(F.slice("block", F.lit(1), i), "a"))
        .bitwiseXOR(_xor(F.slice("block", i + 2, F.lit(BLOCK)), "b")).bitwiseXOR(F.col("mine.b")).alias("key"),
        (F.col("n") - 1).alias("size"), (F.col("k") * BLOCK + i).alias("place")))
    wanted = F.filter(left_out, lambda v: (F.col("late") & (v["place"] >= F.floor((F.col("n") - 1) / 2)))
                      | (F.col("early") & (v["place"] < F.floor(F.col("n") / 2))))
    own = F.struct(F.col("whole").alias("key"), F.col("n").alias("size"), F.lit(-1).alias("place"))
    all_ = F.when(F.col("k") == 0, F.concat(F.array(own), wanted)).otherwise(wanted)
    return rows.select("h1", "h2", *PLACE, F.inline(all_).alias("key", "size", "place"))


def _without(words: str, place: str) -> Column:
    """The words without that of a place; all of them for place -1."""
    p = F.col(place)
    return F.when(p < 0, F.col(words)).otherwise(
        F.concat(F.slice(words, F.lit(1), F.greatest(p, F.lit(0))), F.slice(words, p + 2, F.size(words))))


def near_links(bodies: DataFrame, contents: DataFrame, folder: str) -> DataFrame:
    """(h1, h2, near): the earliest place of a content that is one edit from this one."""
    keys = contents.where("halves is not null").select("h1", "h2", F.inline("halves"))
    shared = keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo != hi").select("key")
    shared = saved(shared, f"{folder}/shared")
    found = common.likely(keys, shared, "key").join(shared, "key").groupBy("h1", "h2").agg(
        F.max("late").alias("late"), F.max(~F.col("late")).alias("early"))
    found = saved(found, f"{folder}/halved")
    found = sift(contents.select("h1", "h2", "first"), found)
    found = saved(found.withColumn("spot", F.xxhash64(*[f"first.{c}" for c in PLACE])), f"{folder}/likely")
    # the words of each such content, from the line that has it first
    rows = with_words(common.likely(bodies.withColumn("spot", F.xxhash64(*PLACE)), found, "spot"))
    rows = rows.join(found.drop("spot"), ["h1", "h2"])
    rows = rows.where(F.struct(*PLACE).eqNullSafe(F.col("first"))).drop("first")
    rows = saved(rows.dropDuplicates(["h1", "h2"]), f"{folder}/rows")

    emitted = variants(rows)
    joint = emitted.groupBy("key", "size").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo != hi")
    joint = saved(joint.select("key", "size"), f"{folder}/joint")
    met = saved(common.likely(emitted, joint, "key").join(joint, ["key", "size"]), f"{folder}/met")
    rank = F.struct(*PLACE, "h1", "h2", "place")
    to = F.struct(*[f"to.{c}" for c in PLACE])
    same = saved(met.groupBy("key", "size", "place").agg(F.min(rank).alias("same")), f"{folder}/same")
    whole = F.min(F.when(F.col("place") < 0, rank))
    part = F.min(F.when(F.col("place") >= 0, rank))
    other = saved(met.groupBy("key", "size").agg(whole.alias("whole"), part.alias("part")), f"{folder}/other")
    found = met.join(same, ["key", "size", "place"]).join(other, ["key", "size"]).select(
        "h1", "h2", "place", F.struct(*PLACE).alias("own"),
        F.when(F.col("place") < 0, F.col("part")).otherwise(
            F.when(F.col("whole") < F.col("same"), F.col("whole")).otherwise(F.col("same"))).alias("to"))
    found = found.where(to < F.col("own")).groupBy("h1", "h2").agg(
        F.min(F.struct("to", "place")).alias("link"))
    found = saved(found.select("h1", "h2", "link.place", "link.to"), f"{folder}/found")

    words = rows.select("h1", "h2", "words")
    there = words.select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("words").alias("their"))
    found = found.join(words, ["h1", "h2"]).withColumn("there", F.col("to.place")).join(
        there, (F.col("to.h1") == F.col("t1")) & (F.col("to.h2") == F.col("t2")))
    one_edit = (_without("words", "place") == _without("their", "there")) & (
        (F.col("place") == F.col("there")) | (F.col("place") < 0) | (F.col("there") < 0))
    return found.where(one_edit).select("h1", "h2", to.alias("near"))


def dropped_lines(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, t1, t2, line, first): each line that goes, and where its earliest copy stands."""
    folder = scratch_folder(docs.sparkSession, "lines")
    bodies = bodies_of(docs, text, id_column)
    halves = F.when(F.size("words") >= min_words, _halves())
    # the hashes of all lines are written, so that what needs no words reads no texts
    lines = saved(once(with_words(bodies), halves=halves).select(*PLACE, "h1", "h2", "halves"), f"{folder}/hashes")
    contents = lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("times"), F.first("halves").alias("halves"))
    contents = saved(contents, f"{folder}/contents")
    near = saved(near_links(bodies, contents, folder), f"{folder}/near")
    several = common.flag(contents.select("h1", "h2", "first", "times"), near, "h1", "linked").where("times > 1 or linked")
    copied = several.join(near, ["h1", "h2"], "left").where("times > 1 or near is not null")
    copied = saved(copied.select("h1", "h2", F.least("first", F.coalesce("near", "first")).alias("first")), f"{folder}/copied")
    return sift(lines.drop("halves"), copied).where(F.col("first") < F.struct(*PLACE)).select(*PLACE, "first")


def per_document(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, __t1, __t2, dropped: the sorted numbers of the lines that go, from 0) of documents that lose a line."""
    gone = dropped_lines(docs, text, id_column).select(*PLACE).distinct()
    return gone.groupBy(F.col("doc").alias(id_column), F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).agg(
        F.sort_array(F.collect_list("line")).alias("dropped"))


def _same(id_column: str, t1: Column, t2: Column) -> Column:
    """Whether a row is the document (__doc, __t1, __t2)."""
    return F.col(id_column).eqNullSafe(F.col("__doc")) & (t1 == F.col("__t1")) & (t2 == F.col("__t2"))


def dedup_lines(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """All rows and columns, the text without the lines that go; rows left without a word go too."""
    gone = per_document(docs, text, id_column).select(
        F.col(id_column).alias("__doc"), "__t1", "__t2", F.col("dropped").alias("__dropped"),
        F.xxhash64(id_column, "__t1").alias("__hash"))
    gone = saved(gone, scratch_folder(docs.sparkSession, "lines-gone"))
    # the other columns travel in one, so that none of them can have the name of a column made here
    others = [c for c in docs.columns if c not in (text, id_column)]
    packed = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").alias("__text"),
                         (F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)).alias("__others"))
    t1, t2 = text_hash("__text")
    # rows that surely lose no line are not shuffled
    rows = common.flag(packed.withColumn("__hash", F.xxhash64("__id", t1)), gone, "__hash", "__touched").drop("__hash")
    touched = rows.where("__touched").join(gone.drop("__hash"), _same("__id", t1, t2), "left")
    lines = F.split("__text", "\n")
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("__dropped", i)), "\n")
    new = F.when(F.col("__dropped").isNull(), F.col("__text")).otherwise(left)
    touched = once(touched, __left=new).where("__dropped is null or __left rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    changed = touched.select("__id", F.col("__left").alias("__text"), "__others")
    found = rows.where("not __touched").drop("__touched").unionByName(changed)
    own = {text: F.col("__text"), id_column: F.col("__id")}
    return found.select(*[(own[c] if c in own else F.col("__others").getField(c)).alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines with a word, how many go, and their numbers."""
    docs = common.table(spark, sf_dir, "documents")
    word_lines = F.size(F.filter(F.split("text", "\n"), lambda b: b.rlike(r"[^\x20\x09-\x0D]")))
    gone = per_document(docs).withColumnRenamed("doc_id", "__doc")
    t1, t2 = text_hash("text")
    rows = docs.select("doc_id", t1.alias("own1"), t2.alias("own2"), F.greatest(F.coalesce(word_lines, F.lit(0)), F.lit(0)).cast("long").alias("n_lines"))
    # documents and verdicts are narrow here, one row each
    return rows.join(gone, _same("doc_id", F.col("own1"), F.col("own2")), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped_lines"))


OP1_SQL = """
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as body, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
  from documents where text is not null
), w as (
  select doc_id, line, [x for x in string_split_regex(body, '[\\x20\\x09-\\x0D]+') if x <> ''] as words
  from l where regexp_matches(body, '[^\\x20\\x09-\\x0D]')
), c as (
  select words, len(words) as n, min(doc_id * 10000000 + line) as first from w group by 1, 2
), v as (
  select words, first, n as size, -1 as place, words as rest from c where n >= 8
  union all
  select words, first, n - 1, p, words[1:p] || words[p + 2:] from (
    select words, first, n, unnest(range(n)) as p from c where n >= 8)
), a as (
  select rest, place, min(first) as same from v group by 1, 2
), b as (
  select rest, min(first) filter (place < 0) as whole, min(first) filter (place >= 0) as part from v group by 1
), e as (
  select v.words, min(least(case when v.place < 0 then b.part else least(a.same, b.whole) end, v.first)) as earliest
  from v join a on a.rest = v.rest and a.place = v.place join b on b.rest = v.rest group by 1
), g as (
  select w.doc_id, w.line from w join c on c.words = w.words left join e on e.words = w.words
  where least(c.first, coalesce(e.earliest, c.first)) < w.doc_id * 10000000 + w.line
), d as (
  select doc_id, count(*) as n, string_agg(line::varchar, ',' order by line) as nos from g group by 1
)
select o.doc_id,
  coalesce(len([x for x in string_split(o.text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')]), 0)::bigint as n_lines,
  coalesce(d.n, 0)::bigint as n_dropped, coalesce(d.nos, '') as dropped_lines
from documents o left join d on d.doc_id = o.doc_id
"""

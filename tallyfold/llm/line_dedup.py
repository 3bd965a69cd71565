"""Line dedup: an exact set-similarity join of lines, in native Spark functions.

A line is the set of its lower-cased words. A line goes when any earlier line (by document id, then line number) has the
same set or one of Jaccard similarity of at least 0.8; earlier lines count whether or not they stay themselves.

Words are ordered by rarity: by their count in the whole corpus, in classes of a quarter of a power of two, then by
hash. Counts are kept in a table of hash buckets of fixed size (a count sketch of one row), which travels with the plan;
a bucket that is shared by several words only makes them seem more frequent: the order stays one and the same for all
lines, so the join stays exact. Two sets of similarity 0.8 share a word among the first n - ceil(0.8 n) + 1 of each (prefix
filter); sizes must be compatible (length filter), what follows the shared word must suffice for the overlap (positional
filter), and odd sketches of 64 bits, of 128 for lines of more than LONG words, whose differing bits are a lower bound of
the sets' difference, must allow it: 64 bits say nothing of sets that may differ in 32 words. Candidates are verified on the words themselves.

Equal sets are one class from the start. Classes are first compared with the earliest one that has the same words at its
begin, middle or end; most near copies find an earlier match there and look no further. All others are joined with all
earlier classes by the filters above, so no match is lost, and the pairs of a group of near copies are at most those of
the members that changed at all three places. Keys with many lines are broadcast (a bounded number), not one task's.

Words travel as 64-bit hashes; lines are told apart by 128 bits of them, and similarities are those of the hash sets.

Defined cases: a null text stays null; empty lines and lines of white space have no words and stay; documents without an
id stay as they are; rows with the same id and text are one document, given several times, and come out alike; different
texts of one id are different documents, in the order of the id, then of a hash of the text; sets of less than four
words match only equal ones, which follows from the threshold; an empty table gives an empty table; other columns are
untouched, but with `counts` the columns n_lines and n_removed replace those of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tables, cut, few, hot_join
from .sharding import numbered

#: The threshold is NUM / DEN.
NUM, DEN = 4, 5
#: Entries of the table of counts: a constant, however large the corpus is.
BUCKETS = 1 << 18
_PART = 1 << 10
#: Words at the begin, in the middle and at the end of a line under which copies find an earlier line first.
ENDS = 6
#: Line numbers of the k-th further text of an id start at k times this.
_TEXT = 1 << 32
#: (document, line) entries that may be broadcast (about 30 bytes each); more are joined by shuffles.
BROADCAST_LINES = 2_000_000


def plain(text: Column) -> Column:
    """The text with all blanks but line ends made spaces, as splitting at one character is cheap; most texts stay as they are."""
    odd = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c"))
    return F.when(odd, F.regexp_replace(text, r"[\t\r\x0b\x0c]", " ")).otherwise(text)


def words_of(line: Column) -> Column:
    """The words of a plain() line, with repeats and empty strings."""
    return F.split(F.lower(line), " ")


def hashes_of(line: Column) -> Column:
    """The hashes of the words of a plain() line, in order."""
    return F.array_remove(F.transform(words_of(line), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def rarity(docs: DataFrame, text: str, buckets: int = BUCKETS) -> str:
    """For each bucket of word hashes, separated by commas: 1 + 4 log2 of the count of its words, at most 126."""
    words = docs.select(F.explode(words_of(F.replace(F.col(text), F.lit("\n"), F.lit(" ")))).alias("w"))
    counts = words.groupBy(_bucket(F.col("w"), buckets).alias("id")).agg(F.count("*").alias("c"))
    level = F.least(F.lit(126), 1 + F.floor(4 * F.log2(F.coalesce("c", F.lit(1)))).cast("int"))
    spelt = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("id")).join(counts, "id", "left").select("id", level.cast("string").alias("x"))
    parts = spelt.groupBy(F.floor(F.col("id") / _PART).alias("part")).agg(F.sort_array(F.collect_list(F.struct("id", "x"))).alias("xs"))
    rows = parts.select("part", F.array_join(F.transform("xs", lambda s: s["x"]), ",").alias("levels")).collect()
    return ",".join(r["levels"] for r in sorted(rows, key=lambda r: r["part"]))


def _bucket(word: Column, buckets: int) -> Column:
    return F.hash(word).bitwiseAND(F.lit(buckets - 1))


def codes_of(words: Column, levels: str, buckets: int) -> Column:
    """Words as numbers that sort by rarity: the class in the highest byte, 56 bits of a hash below."""
    known = F.split(F.lit(levels), ",").cast("array<tinyint>")  # a constant, folded once
    code = lambda w: F.shiftleft(F.get(known, _bucket(w, buckets)).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 8))
    return F.array_remove(F.transform(words, code), code(F.lit("")))


#: The numbers of one bit each: a lookup is cheaper than a shift, which is not compiled here.
_BITS = [1 << i if i < 63 else -(1 << 63) for i in range(64)]


def odd_sketch(codes: Column, part: int | None = None) -> Column:
    """64 bits, each the parity of the codes that fall on it; with `part` only the codes of that quarter of the universe."""
    bits = F.array(*[F.lit(b).cast("long") for b in _BITS])
    bit = lambda c: F.get(bits, c.bitwiseAND(F.lit(63)).cast("int"))
    if part is not None:
        whole = bit
        bit = lambda c: F.when(F.shiftright(c, 6).bitwiseAND(F.lit(3)) == part, whole(c)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: acc.bitwiseXOR(bit(c)))


#: Sets of more words have sketches of 128 bits, in two halves.
LONG = 48


def sketches(codes: Column) -> list[Column]:
    """`odd` and `odd2`: of a long set the two halves of a sketch of 128 bits, else one of 64 bits and 0. XOR folds the halves to 64."""
    half = lambda i: F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: acc.bitwiseXOR(F.get(tables[i], c.bitwiseAND(F.lit(127)).cast("int"))))
    tables = [F.array(*[F.lit(b).cast("long") for b in t]) for t in (_BITS + [0] * 64, [0] * 64 + _BITS)]
    long = F.size(codes) > LONG
    return [F.when(long, half(0)).otherwise(odd_sketch(codes)).alias("odd"), F.when(long, half(1)).otherwise(F.lit(0).cast("long")).alias("odd2")]


def _differing(x: str, y: str) -> Column:
    """The differing bits of two sketches; if only one is of 128 bits, it is folded."""
    a, b = (F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")) for c in ("odd", "odd2"))
    both = (F.abs(F.col(f"{x}.n")) > LONG) & (F.abs(F.col(f"{y}.n")) > LONG)
    return F.when(both, F.bit_count(a) + F.bit_count(b)).otherwise(F.bit_count(a.bitwiseXOR(b)))


def _needed(a: Column, b: Column) -> Column:
    """The least overlap of two sets of sizes a and b."""
    return F.ceil((a + b) * NUM / (NUM + DEN) - 1e-9)


def _allowed(x: str, y: str) -> Column:
    """Length and sketch filter; a negative size of x lets nothing pass."""
    a, b = F.col(f"{x}.n"), F.abs(F.col(f"{y}.n"))
    return (F.least(a, b) * DEN >= F.greatest(a, b) * NUM) & (_differing(x, y) <= a + b - 2 * _needed(a, b))


def _enough(x: str, y: str) -> Column:
    """Positional filter: what follows the shared word suffices for the overlap."""
    a, b = F.col(f"{x}.n"), F.abs(F.col(f"{y}.n"))
    return F.least(a - F.col(f"{x}.p"), b - F.col(f"{y}.p")) >= _needed(a, b)


def _joined(docs: DataFrame, per_doc: DataFrame, entries: int, how: str) -> DataFrame:
    """`docs` with a table of lines by document, which is broadcast while its size allows."""
    return docs.join(F.broadcast(per_doc) if entries <= BROADCAST_LINES else per_doc, "doc", how)


def _sets(pairs: DataFrame, docs: DataFrame, kept: Tables) -> DataFrame:
    """(doc, line, words, n, s0..s3) of the lines in pairs: sets of hashes with sketches of 256 bits."""
    ends = cut(pairs.select("doc", "line").unionByName(pairs.select(F.col("doc2").alias("doc"), F.col("line2").alias("line"))).distinct())
    wanted = ends.groupBy("doc").agg(F.collect_list("line").alias("wanted"))
    lines = _joined(docs, wanted, ends.count(), "inner").select("doc", "base", "wanted", F.split("text", "\n", -1).alias("lines"))
    # a text of a repeated id has only the lines of its own range
    lines = lines.select("doc", "base", "lines", F.explode("wanted").alias("line")).where(F.col("line").between(F.col("base"), F.col("base") + _TEXT - 1))
    lines = lines.select("doc", "line", F.get("lines", (F.col("line") - F.col("base")).cast("int")).alias("text"))
    sets = lines.select("doc", "line", F.array_distinct(hashes_of(F.col("text"))).alias("words"))
    return kept.keep(sets.select("doc", "line", "words", F.size("words").alias("n"), *[odd_sketch(F.col("words"), i).alias(f"s{i}") for i in range(4)]), "sets")


def _partner(sets: DataFrame, columns: list[str]) -> DataFrame:
    return sets.select(F.col("doc").alias("doc2"), F.col("line").alias("line2"), *[F.col(c).alias(f"{c}_2") for c in columns])


def _matching(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (doc, line) of pairs whose sets are similar enough."""
    own = pairs.select("doc", "line", "doc2", "line2").join(sets.select("doc", "line", "words"), ["doc", "line"]).join(_partner(sets, ["words"]), ["doc2", "line2"])
    shared = F.size(F.array_intersect("words", "words_2"))
    return own.where(shared * DEN >= NUM * (F.size("words") + F.size("words_2") - shared)).select("doc", "line").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, kept: Tables) -> DataFrame:
    """Of materialised pairs (doc, line, doc2, line2, apart) the distinct (doc, line) that match.

    Each line is first compared with its likeliest partner alone, as most lines with a match have many. Of lines without
    a match there, sketches of 256 bits thin out the other partners.
    """
    likeliest = pairs.groupBy("doc", "line").agg(F.min(F.struct("apart", "doc2", "line2")).alias("best")).select("doc", "line", "best.doc2", "best.line2")
    likeliest = cut(likeliest)
    hit = cut(_matching(likeliest, _sets(likeliest, docs, kept)))
    others = pairs.join(few(hit, BROADCAST_LINES), ["doc", "line"], "left_anti").join(few(likeliest, BROADCAST_LINES), ["doc", "line", "doc2", "line2"], "left_anti")
    others = cut(others.select("doc", "line", "doc2", "line2"))
    if others.isEmpty():
        return hit
    sets, narrow = _sets(others, docs, kept), ["n", "s0", "s1", "s2", "s3"]
    both = others.join(sets.select("doc", "line", *narrow), ["doc", "line"]).join(_partner(sets, narrow), ["doc2", "line2"])
    apart = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"s{i}_2"))) for i in range(1, 4)), F.bit_count(F.col("s0").bitwiseXOR(F.col("s0_2"))))
    thin = cut(both.where(apart <= F.col("n") + F.col("n_2") - 2 * _needed(F.col("n"), F.col("n_2"))).select("doc", "line", "doc2", "line2"))
    return hit.unionByName(_matching(thin, sets)).distinct()


def _apart(x: str, y: str) -> Column:
    """How unlike two lines look: differing bits of their sketches for their size."""
    return _differing(x, y) / (F.col(f"{x}.n") + F.abs(F.col(f"{y}.n")))


def identified(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """`docs` with `doc` and `base`, the number of the first line: 0, and more for further texts of an id; whether ids repeat."""
    own = docs.withColumns({"doc": F.col(key), "__hash": F.xxhash64(text)})
    several = own.where(F.col("doc").isNotNull() & F.col(text).isNotNull()).groupBy("doc").agg(F.min("__hash").alias("low"), F.max("__hash").alias("high"), F.count("*").alias("copies")).where("copies > 1")
    several = cut(several)
    differing = cut(several.where("low <> high").select("doc"))
    if differing.isEmpty():
        return own.withColumn("base", F.lit(0).cast("long")).drop("__hash"), not several.isEmpty()
    texts = cut(own.join(few(differing), "doc").select("doc", "__hash").distinct())
    ranked = cut(numbered(texts, ["doc"], ["__hash"], texts.count(), "rank").select("doc", "__hash", "rank"))
    return own.join(few(ranked), ["doc", "__hash"], "left").withColumn("base", F.coalesce(F.col("rank") * _TEXT, F.lit(0).cast("long"))).drop("__hash", "rank"), True


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(doc, line) of all lines that go; lines are counted from 0, those of further texts of an id from `base`."""
    own, repeated = identified(docs.select(key, text), key, text)
    return _removed(own.select("doc", "base", F.col(text).alias("text")), repeated, buckets)


def _removed(docs: DataFrame, repeated: bool, buckets: int) -> DataFrame:
    # a text that can't be null is not made plain twice, once for a filter that Spark adds
    own = docs.where("doc is not null and text is not null").select("doc", "base", F.coalesce(plain(F.col("text").cast("string")), F.lit("")).alias("text"))
    if repeated:
        own = own.dropDuplicates(["doc", "base"])
    levels = rarity(own, "text", buckets)
    # lines without words go by their text: a filter on the codes would work them out twice
    split = own.select("doc", "base", F.posexplode(F.split("text", "\n", -1)).alias("at", "text")).where(F.trim("text") != "")
    split = split.select("doc", (F.col("base") + F.col("at")).alias("line"), codes_of(words_of(F.col("text")), levels, buckets).alias("h"))
    middle = F.greatest(F.floor((F.size("h") - ENDS) / 2).cast("int") + 1, F.lit(1))
    ends = {"head": F.lit(1), "middle": middle, "tail": F.greatest(F.size("h") - (ENDS - 1), F.lit(1))}
    ends = [F.xxhash64(F.lit(i), F.slice("h", at, F.lit(ENDS))).alias(k) for i, (k, at) in enumerate(ends.items())]
    coded = split.select("doc", "line", *ends, F.sort_array(F.array_distinct("h")).alias("codes"))
    n = F.size("codes")
    prefix = F.when(n >= 4, F.slice("codes", F.lit(1), n - F.ceil(n * NUM / DEN - 1e-9).cast("int") + 1)).otherwise(F.slice("codes", 1, 0))
    kept = Tables(docs.sparkSession)
    lines = kept.keep(coded.select("doc", "line", F.xxhash64("codes").alias("h1"), F.xxhash64(F.lit(1), "codes").alias("h2"), n.alias("n"), *sketches(F.col("codes")), *[k for k in ("head", "middle", "tail")], prefix.alias("prefix")), "lines")

    # equal sets: all but the first go; the first stands for its class
    place = F.struct("doc", "line")
    repeated = cut(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    again = hot_join(lines.select("doc", "line", "h1", "h2"), repeated, ["h1", "h2"], "copies", "inner")
    again = cut(again.where(F.col("first") != place).select("doc", "line"))
    classes = lines.where("n >= 4").join(few(again, BROADCAST_LINES), ["doc", "line"], "left_anti")

    # the earliest document of an end, then its earliest line: sums of plain numbers, so combined before the shuffle
    row = ["doc", "line", "n", "odd", "odd2"]
    ends = classes.select(*row, F.explode(F.array("head", "middle", "tail")).alias("end"))
    shared = cut(ends.groupBy("end").agg(F.min("doc").alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    small = shared.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    led = cut((ends.join(F.broadcast(shared), "end") if small else hot_join(ends, shared, ["end"], "copies", "inner")).drop("copies"))
    leads = cut(led.where("doc = first").groupBy("end").agg(F.min(F.struct(*row)).alias("lead")))
    leads = cut(leads.join(shared.select("end", "copies"), "end"))
    stars = hot_join(led.select("end", F.struct(*row).alias("own")), leads, ["end"], "copies", "inner")
    stars = stars.where("lead.doc <> own.doc or lead.line <> own.line").where(_allowed("own", "lead"))
    stars = cut(stars.select("own.doc", "own.line", F.col("lead.doc").alias("doc2"), F.col("lead.line").alias("line2"), _apart("own", "lead").alias("apart")).distinct())
    matched = cut(_verified(stars, own, kept))

    done = matched.withColumn("done", F.lit(True))
    flagged = classes.join(few(done, BROADCAST_LINES), ["doc", "line"], "left")
    # a class that has its match gets a negative size, which lets it be found but not look any further; that test is part
    # of the length filter, which sees both sides, so that one shuffle serves both
    rows = flagged.select("doc", "line", F.when(F.col("done"), -F.col("n")).otherwise(F.col("n")).alias("n"), "odd", "odd2", F.posexplode("prefix").alias("p", "code"))
    x, y = rows.alias("x"), rows.alias("y")
    earlier = (F.col("y.doc") < F.col("x.doc")) | ((F.col("y.doc") == F.col("x.doc")) & (F.col("y.line") < F.col("x.line")))
    met = x.join(y, F.col("x.code") == F.col("y.code")).where(_allowed("x", "y") & _enough("x", "y") & earlier)
    met = met.select(F.col("x.doc").alias("doc"), F.col("x.line").alias("line"), F.col("y.doc").alias("doc2"), F.col("y.line").alias("line2"), _apart("x", "y").alias("apart"))
    met = cut(met.distinct())
    out = cut(again.unionByName(matched).unionByName(_verified(met, own, kept)).distinct())
    kept.drop()
    return out


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", counts: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """`docs` without the lines that go; with `counts` also n_lines and n_removed."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    old = names[docs.columns.index(text)]
    own, repeated = identified(docs.toDF(*names), names[docs.columns.index(key)], old)
    gone = _removed(own.select("doc", "base", F.col(old).alias("text")), repeated, buckets)
    per_doc = gone.groupBy("doc").agg(F.collect_set("line").alias("__all"))
    joined = _joined(own, per_doc, gone.count(), "left").withColumn("__lines", F.split(old, "\n", -1))
    mine = F.filter("__all", lambda i: (i >= F.col("base")) & (i < F.col("base") + _TEXT))
    joined = joined.withColumn("__gone", F.transform(mine, lambda i: (i - F.col("base")).cast("int")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")
    intact = F.col("__gone").isNull() | (F.size("__gone") == 0) | F.col(old).isNull()
    added = {}
    if counts:
        added = {"n_lines": F.when(F.col(old).isNull(), 0).otherwise(F.size("__lines")).cast("long"), "n_removed": F.when(intact, 0).otherwise(F.size("__gone")).cast("long")}
    columns = [(F.when(intact, F.col(old)).otherwise(left) if c == text else F.col(n)).alias(c) for n, c in zip(names, docs.columns, strict=True) if c not in added]
    return joined.select(*columns, *[c.alias(k) for k, c in added.items()])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat or nearly repeat an earlier one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, counts=True)


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(0, len(ls)))::INT AS line, unnest(ls) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
), s AS (
  SELECT doc_id, line, t, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(t), '[\t-\r ]+'), lambda x: x <> ''))) AS w FROM l
), c AS (
  SELECT w, min(struct_pack(doc_id := doc_id, line := line)) AS pos, len(w) AS n FROM s WHERE len(w) > 0 GROUP BY w
), f AS (SELECT x, count(*) AS df FROM (SELECT unnest(w) AS x FROM c) GROUP BY x),
r AS (
  SELECT pos, n, x, row_number() OVER (PARTITION BY pos ORDER BY df, x) AS k FROM (SELECT pos, n, unnest(w) AS x FROM c WHERE n >= 4) JOIN f USING (x)
), p AS (SELECT pos, n, x FROM r WHERE k <= n - (4 * n + 4) // 5 + 1),
cand AS (
  SELECT DISTINCT a.pos AS a, b.pos AS b FROM p a JOIN p b ON a.x = b.x AND b.pos < a.pos AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), hit AS (
  SELECT DISTINCT a FROM (
    SELECT a, len(list_intersect(u.w, v.w)) AS i, len(u.w) + len(v.w) AS t FROM cand JOIN c u ON u.pos = a JOIN c v ON v.pos = b
  ) WHERE 5 * i >= 4 * (t - i)
), gone AS (
  SELECT s.doc_id, s.line FROM s JOIN c ON s.w = c.w WHERE c.pos <> struct_pack(doc_id := s.doc_id, line := s.line)
  UNION SELECT a.doc_id, a.line FROM hit
)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.t, '') END AS text,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id
LEFT JOIN (
  SELECT l.doc_id, string_agg(t, chr(10) ORDER BY line) AS t FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.line = gone.line GROUP BY l.doc_id
) k ON k.doc_id = d.doc_id
"""

"""Line dedup by a segment-partition edit join, in Spark's own expressions.

Two lines within ``edits`` edits share at least one of ``edits + 1`` segments, nearly in place. So the
distinct lines are indexed by the segments they are cut into, each with its number and the line's
length, and every line probes with the substrings of its own that such a segment could be, for its
length and the shorter ones in reach. Pairs that meet are verified by banded bit-parallel edit
distance: one word of ``2 * edits + 2`` bits moves along the diagonal, over what lies between the
lines' common beginning and common end. Linked lines form groups; of each group only its first line
stays, by document id and place in the document.

Defined results: lines are what newlines separate. Lines of white space only always stay. Lines of
fewer than ``SHORTEST`` characters repeat only lines equal to them. Null text is a text without lines;
it and empty text stay as they are. Documents without an id come after all others. Rows that repeat an
id and a line in its place repeat that place: they all stay, or all go. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trueledger.llm.common import stored, text_key, unused
from trueledger.llm.components import components

EDITS = 2
SHORTEST = 20
#: Shortest strings the bit-parallel comparison is given.
_LEAST = 8
_LAST_ID = "9223372036854775808"


def segment(length: Column, number: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and size of a line's segment ``number`` (from 1): even cuts, the longer ones last."""
    size = F.floor(length / (edits + 1))
    longer = length % (edits + 1)
    extra = F.greatest(F.lit(0), F.lit(number - 1 - (edits + 1)) + longer)
    return (
        ((number - 1) * size + extra + 1).cast("int"),
        (size + F.when(F.lit(number - 1) >= edits + 1 - longer, 1).otherwise(0)).cast("int"),
    )


def probes(edits: int) -> list[tuple[int, int, int]]:
    """``(shorter by, segment number, shift)`` of every substring that a line must look up."""
    return [
        (gap, k, shift)
        for gap in range(edits + 1)
        for k in range(1, edits + 2)
        for shift in range(max(1 - k, gap - (edits + 1 - k)), min(k - 1, gap + (edits + 1 - k)) + 1)
    ]


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def bit_parallel_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of ``a`` and ``b`` where it is at most ``edits``, else something larger.

    Both must be at least ``edits`` characters long and free of newlines, with lengths that differ by
    at most ``edits``. Bit ``i`` of the words stands for the row ``i - edits - 1`` below the diagonal.
    """
    width = 2 * edits + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    pad = "\n" * width
    rows = F.split(F.concat(F.lit("\n" * (edits + 1)), a, F.lit(pad)), "")
    columns = F.split(b, "")

    def matches(char: Column, at: Column, padded: Column) -> Column:
        total = F.lit(0)
        for bit in range(width):
            total = total + F.when(F.get(padded, at + bit) == char, 1 << bit).otherwise(0)
        return total

    masks = _let(rows, lambda padded: F.transform(columns, lambda char, at: matches(char, at, padded)))
    begin = F.struct(
        F.lit(0).alias("at"), F.lit((full << (width - edits - 1)) & full).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("far"), F.lit(top >> 1).alias("bit")
    )

    def step(acc: Column, pm: Column, stop: Column) -> Column:
        vp, vn = acc["vp"], acc["vn"]
        x = pm.bitwiseAND(vp)
        d0 = (x + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(F.lit(full))

        def with_d0(d0: Column) -> Column:
            hp = vn.bitwiseOR(d0.bitwiseOR(vp).bitwiseXOR(F.lit(full)))

            def with_hp(hp: Column) -> Column:
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                diagonal = acc["at"] < stop
                along = F.when(d0.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)
                across = F.when(hp.bitwiseAND(acc["bit"]) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(acc["bit"]) != 0, 1).otherwise(0)
                return F.struct(
                    (acc["at"] + 1).alias("at"),
                    hn.bitwiseOR(down.bitwiseOR(hp).bitwiseXOR(F.lit(full))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"),
                    (acc["far"] + F.when(diagonal, along).otherwise(across)).alias("far"),
                    F.when(diagonal, acc["bit"]).otherwise(F.shiftright(acc["bit"], 1)).alias("bit"),
                )

            return _let(hp, with_hp)

        return _let(d0, with_d0)

    return _let(F.length(a) - edits, lambda stop: F.aggregate(masks, begin, lambda acc, pm: step(acc, pm, stop), lambda acc: acc["far"]))


def _common(a: Column, b: Column, most: Column, end: bool) -> Column:
    """Length of the common beginning (or end) of ``a`` and ``b``, up to ``most``, by halving steps."""
    steps = F.array(*[F.lit(1 << s) for s in range(20, -1, -1)])
    part = (lambda s, n: F.right(s, n)) if end else (lambda s, n: F.left(s, n))
    return F.aggregate(steps, F.lit(0), lambda got, s: F.when((got + s <= most) & (part(a, got + s) == part(b, got + s)), got + s).otherwise(got))


def verified(pairs: DataFrame, edits: int) -> DataFrame:
    """The rows of ``pairs (…, line_a, line_b)`` whose lines are within ``edits`` edits.

    One expression from lambda to lambda, so that each value is computed once wherever the filter goes.
    """
    both = F.array(F.struct(F.col("line_a").alias("a"), F.col("line_b").alias("b")))
    shorter = lambda p: F.least(F.length(p["a"]), F.length(p["b"])) - _LEAST
    begun = F.transform(both, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), _common(p["a"], p["b"], shorter(p), False).alias("n")))
    rest = F.transform(begun, lambda p: F.struct(p["a"].substr(p["n"] + 1, F.length(p["a"])).alias("a"), p["b"].substr(p["n"] + 1, F.length(p["b"])).alias("b")))
    ended = F.transform(rest, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), _common(p["a"], p["b"], shorter(p), True).alias("n")))
    middle = F.transform(ended, lambda p: F.struct(F.left(p["a"], F.length(p["a"]) - p["n"]).alias("a"), F.left(p["b"], F.length(p["b"]) - p["n"]).alias("b")))
    distance = lambda p: F.when(_may_be_near(p["a"], p["b"], edits), bit_parallel_distance(p["a"], p["b"], edits)).otherwise(edits + 1)
    return pairs.where(F.transform(middle, distance)[0] <= edits)


def _may_be_near(a: Column, b: Column, edits: int, parts: int = 16) -> Column:
    """False only for strings further apart than ``edits``: of ``parts`` parts each edit changes one at most."""
    size = (F.length(a) / parts).cast("int")

    def stands(i: Column) -> Column:
        start = i * size + 1
        before = F.least(F.lit(edits), start - 1)
        return F.contains(b.substr(start - before, size + before + edits), a.substr(start, size))

    unchanged = F.size(F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), stands))
    return (F.length(a) < 4 * parts) | (unchanged >= parts - edits)


@contextmanager
def _bloom_filters(spark: SparkSession) -> Iterator[None]:
    """Lets Spark filter the large side of a join by a Bloom filter of the small one, at any size."""
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "0")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def occurrences(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, at, line`` of every line that is not blank; ``pos`` orders them."""
    lines = df.select(F.col(id_col).cast("long").alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("at", "line"))
    pos = F.coalesce(F.col("id").cast("decimal(38,0)"), F.expr(f"cast({_LAST_ID} as decimal(38,0))")) * F.expr("cast(4294967296 as decimal(38,0))") + F.col("at")
    return lines.where("line rlike '\\\\S'").withColumn("pos", pos.cast("decimal(38,0)"))


#: Letters that a line's signature counts; an edit changes two of the counts by one at most.
_LETTERS = "etaoinsrhdlucgmw"
_BITS = 64 // len(_LETTERS)


def with_signature(lines: DataFrame) -> DataFrame:
    """``lines`` with ``size``, and ``sig``: the counts of some letters, the last bits of each."""
    count = lambda c: (F.length("line") - F.length(F.replace("line", F.lit(c), F.lit("")))).cast("long").bitwiseAND(F.lit((1 << _BITS) - 1))
    sig = F.lit(0).cast("long")
    for i, c in enumerate(_LETTERS):
        sig = sig.bitwiseOR(F.shiftleft(count(c), _BITS * i))
    return lines.withColumns({"size": F.length("line"), "sig": sig})


def _letters_apart(a: Column, b: Column) -> Column:
    """At most the number of letters by which two signatures' lines differ."""
    total, mask = F.lit(0), F.lit((1 << _BITS) - 1)
    for i in range(len(_LETTERS)):
        of = lambda s, i=i: F.shiftrightunsigned(s, _BITS * i).bitwiseAND(mask)
        apart = (of(a) - of(b)).bitwiseAND(mask)
        total = total + F.least(apart, (1 << _BITS) - apart)
    return total


def _keyed(sized: DataFrame, edits: int, shortest: int) -> DataFrame:
    """``h, tag``: what each line is indexed by and looks up; ``tag`` is twice its id, and one more where it is indexed.

    Looking up a segment in place, for the line's own length, is what the line is indexed by itself.
    """
    size = F.col("size")

    def key(length: Column, number: int, start: Column, count: Column) -> Column:
        return F.xxhash64(length, F.lit(number), F.substring("line", start, count))

    def entry(gap: int, number: int, shift: int) -> Column:
        length = size - gap
        start, count = segment(length, number, edits)
        if (gap, shift) == (0, 0):
            return key(size, number, start, count)
        start = start + shift
        fits = (length >= shortest) & (start >= 1) & (start + count - 1 <= size)
        return F.when(fits, key(length, number, start, count))

    places = sorted(probes(edits), key=lambda p: (p[0], p[2]) != (0, 0))  # those it is indexed by first
    entries = sized.select("id", F.posexplode(F.array(*[entry(*p) for p in places])).alias("at", "h")).where("h IS NOT NULL")
    return entries.select("h", (F.shiftleft("id", 1) + (F.col("at") <= edits).cast("int")).alias("tag"))


def links(lines: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """``a, b``: ids of lines of ``lines (id, line, size)`` (distinct, settled) within ``edits`` edits.

    Most lines share no key with another one; they go no further than one sort by key. The others get
    a signature, and those that meet on a segment but differ in too many letters are no pair to begin
    with, so a group of lines with a common part does not make all its pairs.
    """
    spark = lines.sparkSession
    of_key = Window.partitionBy("h")
    id_of, indexed = F.shiftright("tag", 1), F.col("tag").bitwiseAND(F.lit(1))
    seen = _keyed(lines.where(F.col("size") >= shortest), edits, shortest).select("h", "tag", F.min(id_of).over(of_key).alias("low"), F.max(id_of).over(of_key).alias("high"), F.max(indexed).over(of_key).alias("held"))
    live = stored(seen.where("low <> high AND held = 1").select("h", id_of.alias("id"), (indexed == 1).alias("indexed")), "line-live")
    wanted = stored(live.select("id").distinct(), "line-wanted").where("id >= 0")
    with _bloom_filters(spark):
        texts = stored(with_signature(lines.select("id", "line").join(wanted, "id")).select("id", "line", "sig"), "line-texts")
    signed = live.join(texts.select("id", "sig"), "id")
    index, probe = signed.where("indexed").drop("indexed"), signed.select("h", F.col("id").alias("by"), F.col("sig").alias("by_sig"))
    near = (F.col("id") != F.col("by")) & (_letters_apart(F.col("sig"), F.col("by_sig")) <= 2 * edits)
    met = index.join(probe, "h").where(near).select(F.least("id", "by").alias("a"), F.greatest("id", "by").alias("b")).distinct()
    pairs = stored(met, "line-pairs")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    return stored(verified(both.select("a", "b", "line_a", "line_b"), edits).select("a", "b"), "line-links")


def repeated(df: DataFrame, id_col: str = "doc_id", text: str = "text", edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """``id, at, first_id, first_at``: every line that repeats an earlier one, and the first of its group."""
    lines = occurrences(df, id_col, text)
    distinct = lines.groupBy("line").agg(F.min("pos").alias("pos"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id())
    distinct = stored(distinct.withColumn("size", F.length("line")), "lines")
    groups = stored(components(links(distinct, edits, shortest)), "line-groups")
    members = distinct.select("id", F.col("pos").alias("own")).join(groups.select(F.col("node").alias("id"), "component"), "id")
    firsts = members.groupBy("component").agg(F.min("own").alias("first"))
    grouped = stored(members.join(firsts, "component").select("id", "first"), "line-firsts")
    decided = distinct.join(grouped, "id", "left").where("n > 1 OR first IS NOT NULL")
    decided = stored(decided.select(text_key(F.col("line")).alias("key"), F.coalesce("first", "pos").alias("first")), "line-decided")
    places = lines.select("id", "at", "pos", text_key(F.col("line")).alias("key"))
    found = places.join(decided, "key").where("pos <> first")
    unit = F.expr("cast(4294967296 as decimal(38,0))")
    first_id = F.floor(F.col("first") / unit)
    return found.select(
        "id",
        "at",
        F.when(first_id < F.expr(f"cast({_LAST_ID} as decimal(38,0))"), first_id).cast("long").alias("first_id"),
        (F.col("first") % unit).cast("int").alias("first_at"),
    )


def per_document(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_lines, n_dropped, dropped``; ``dropped`` lists each line that goes and the first of its group."""
    gone = found.distinct().groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "first_id", "first_at"))).alias("dropped"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0)).alias("n_lines"))
    joined = rows.alias("r").join(gone.alias("g"), F.col("r.id").eqNullSafe(F.col("g.id")), "left")
    none = F.expr("cast(array() as array<struct<at: int, first_id: bigint, first_at: int>>)")
    return joined.select(
        F.col("r.id").alias("id"), F.col("n_lines").cast("long"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("dropped", none).alias("dropped")
    )


def without_repeats(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the repeated lines taken out of ``text``; documents that lose every line go."""
    gone_id, gone, left = (unused(df, n) for n in ("gone_id", "gone", "left"))
    lost = found.distinct().groupBy(F.col("id").alias(gone_id)).agg(F.collect_list("at").alias(gone))
    joined = df.join(lost, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(gone_id)), "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    # The places that stay, as a difference of sets: time grows with the lines, not with lines times repeats.
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    joined = joined.withColumn(left, F.when(F.col(gone).isNotNull(), _let(lines, lambda whole: F.transform(places, lambda at: F.get(whole, at)))))
    stays = F.col(left).isNull() | F.exists(left, lambda line: line.rlike(r"\S"))
    kept = F.when(F.col(left).isNotNull(), F.array_join(left, "\n")).otherwise(F.col(f"`{text}`"))
    return joined.where(stays).withColumn(text, kept).select(*[F.col(f"`{c}`") for c in df.columns])

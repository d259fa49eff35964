"""Near-duplicate lines: an exact set-similarity join in DataFrame functions only.

A line is the set of its words. Words are ordered by rarity, by the class of
their corpus frequency in a table of fixed size and then by hash. Two sets
with Jaccard similarity t share a word in their rarest few (prefix filter), at
positions that leave room for the overlap (positional filter), and have
lengths within a factor t (length filter). What passes is verified on words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from canton.session import broadcast_if_small as small, stored_table as stored

SIMILARITY = 0.8
CELLS = 1 << 17  # word counts are summed in this many cells, whatever the corpus
BROADCAST_ROWS = 200_000  # keys of at most some tens of bytes; more are joined by a shuffle

LONG = 96  # words from which a set has the larger sketch
HOT = 32  # sets with a common word in their prefixes that meet their earliest first
GAIN = 0.2  # of the sets removed so far that a round must remove for another one

TURNS = ("turn = 1", "turn BETWEEN 2 AND 4", "turn BETWEEN 5 AND 16", "turn > 16")  # of a set's candidates

_LAST = (1 << 63) - 1
_KEY = ["k1", "k2"]
_PLACE = ["d", "h", "no"]
_SPACES = "[ \\t\\n\\r\\f\\x0B]"


def _small(stored_table: DataFrame) -> DataFrame:
    return small(stored_table, BROADCAST_ROWS)


def _split(text: Column) -> Column:
    """The words of a text between ASCII white space, repeated ones included, and empty texts."""
    # A split at one plain character needs no pattern; only texts with rarer white space go through one.
    rows = F.replace(text, F.lit("\n"), F.lit(" "))
    rare = reduce(Column.__or__, [F.contains(rows, F.lit(c)) for c in "\t\r\f\x0b"])
    plain = F.when(rare, F.regexp_replace(rows, _SPACES, " ")).otherwise(rows)
    return F.split(plain, " ")


def _words(text: Column) -> Column:
    """The words of a text between ASCII white space, repeated ones included."""
    return F.array_remove(_split(text), "")


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents by their order: doc_id, NULL last, then a hash of the text."""
    return docs.withColumns(
        {"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "h": F.xxhash64("text")}
    )


def frequency_classes(docs: DataFrame) -> Column:
    """A constant array: per cell of word hashes, four times the log of its count.

    One row of CELLS numbers reaches the driver, whatever the size of the corpus.
    """
    cell = F.xxhash64(F.col("word")).bitwiseAND(F.lit(CELLS - 1))
    words = docs.select(F.explode(_split(F.col("text"))).alias("word")).where("word != ''")
    counts = words.groupBy(cell.alias("id")).count()
    cells = docs.sparkSession.range(CELLS).join(counts, "id", "left")
    level = F.floor(4 * F.log2(F.coalesce("count", F.lit(0)) + 1)).cast("tinyint")
    listed = F.sort_array(F.collect_list(F.struct("id", level.alias("level"))))
    text = cells.agg(F.to_json(F.transform(listed, lambda x: x["level"]))).first()[0]
    return F.from_json(F.lit(text), "array<tinyint>")


def line_classes(docs: DataFrame, similarity: float) -> DataFrame:
    """One row per distinct word set of a line: its key, first place, size and prefix.

    Each word flips one of 64 ``bits`` by its hash, so two sets differ in no
    more bits than words: that rejects most pairs inside the join. Sets of more
    than LONG words have 128: ``far`` is the part of the words in the upper half.
    """
    levels = frequency_classes(docs)

    def ordered(value: Column) -> Column:
        level = F.get(levels, value.bitwiseAND(F.lit(CELLS - 1)).cast("int")).cast("long")
        return F.shiftleft(level, 55).bitwiseOR(F.shiftrightunsigned(value, 9))

    lines = docs.select("d", "h", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    # Words are told apart by 64-bit hashes here; what passes is verified on the words.
    hashes = F.transform(_words(F.col("line")), lambda word: F.xxhash64(word))
    sets = lines.select(
        *_PLACE, F.sort_array(F.array_distinct(F.transform(hashes, ordered))).alias("words")
    ).withColumn("n", F.size("words"))
    spare = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def flip(x: Column) -> Column:
        return F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))

    sets = sets.select(
        *_PLACE,
        "n",
        F.xxhash64("words").alias("k1"),
        F.xxhash64(F.lit(1), "words").alias("k2"),
        F.transform(F.slice("words", F.lit(1), spare.cast("int")), lambda x: F.hash(x)).alias("prefix"),
        F.aggregate("words", zero, lambda a, x: a.bitwiseXOR(flip(x))).alias("bits"),
        F.when(
            F.col("n") > LONG,
            F.aggregate(
                "words", zero, lambda a, x: F.when(x.bitwiseAND(F.lit(64)) == 0, a).otherwise(a.bitwiseXOR(flip(x)))
            ),
        ).otherwise(zero).alias("far"),
    )
    classes = sets.groupBy(*_KEY).agg(
        F.min(F.struct(*_PLACE)).alias("first"),
        F.any_value("n").alias("n"),
        F.any_value("prefix").alias("prefix"),
        F.any_value("bits").alias("bits"),
        F.any_value("far").alias("far"),
    )
    # Here, as a filter before the sums would make the words of every line a second time.
    return classes.where("n > 0").select(*_KEY, "first.*", "n", "prefix", "bits", "far")


def _passes(similarity: float, positions: bool) -> Column:
    """Length, bit and (with ``positions``) positional filter of the sets a and b."""
    n_a, n_b = F.col("a.n"), F.col("b.n")
    overlap = F.ceil((n_a + n_b) * (similarity / (1 + similarity)) - 1e-9)
    bits = F.col("a.bits").bitwiseXOR(F.col("b.bits"))
    far = F.col("a.far").bitwiseXOR(F.col("b.far"))
    different = F.when(
        F.least(n_a, n_b) > LONG, F.bit_count(bits.bitwiseXOR(far)) + F.bit_count(far)
    ).otherwise(F.bit_count(bits))
    tests = [
        F.least(n_a, n_b) >= F.greatest(n_a, n_b) * similarity - 1e-9,
        different <= n_a + n_b - 2 * overlap,
    ]
    if positions:
        tests.append(F.least(n_a - F.col("a.pos"), n_b - F.col("b.pos")) >= overlap)
    return reduce(Column.__and__, tests)


def _beaten(docs: DataFrame, classes: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Keys of the later sets of the pairs (``a``, ``b``, by k1) whose words are similar enough.

    Each set is verified against its earliest candidate first; those it loses
    to leave, and only the others go on to their next ones: a set that many
    earlier ones resemble is compared with one or a few of them.
    """
    pairs = pairs.select(
        F.col("a.k1").alias("a_k1"), F.col("b.k1").alias("b_k1"), F.col("a.d").alias("a_d"), F.col("b.d").alias("b_d")
    ).distinct()
    pairs = pairs.select(
        "a_k1", "b_k1",
        F.least("a_d", "b_d").alias("d"),
        # NULL within one document, where the line numbers decide: such pairs are all verified at once.
        F.when(F.col("a_d") < F.col("b_d"), F.col("b_k1")).when(F.col("a_d") > F.col("b_d"), F.col("a_k1")).alias("k1"),
    )
    # One pass: parts by k1, joined by a union, would each make all pairs.
    alone = F.when(F.col("k1").isNull(), F.xxhash64("a_k1", "b_k1"))
    turn = F.row_number().over(Window.partitionBy("k1", alone).orderBy("d", "a_k1", "b_k1"))
    pairs = stored(pairs.withColumn("turn", F.when(F.col("k1").isNull(), 1).otherwise(turn)), "pairs")
    ends = stored(pairs.select(F.col("a_k1").alias("k1")).union(pairs.select("b_k1")).distinct(), "ends")
    places = stored(classes.select(*_KEY, *_PLACE).join(_small(ends), "k1"), "places")
    wanted = places.groupBy("d", "h").agg(F.collect_list(F.struct("no", *_KEY)).alias("sets"))
    if places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # a document's list is as long as its places are many
    lines = docs.select("d", "h", "text").join(wanted, ["d", "h"])
    # A repeated row brings its lines twice, with equal words. The line is one value, its words are many.
    words = stored(
        lines.select("d", "h", F.split("text", "\n").alias("all"), F.explode("sets").alias("s"))
        .select(
            F.col("s.k1").alias("k1"),
            F.struct("d", "h", "s.no").alias("place"),
            F.struct("s.k1", "s.k2").alias("key"),
            F.get("all", F.col("s.no")).alias("line"),
        )
        .dropDuplicates(["key"])
        .withColumn("n", F.size(F.array_distinct(_words(F.col("line"))))),
        "words",
    )
    side = lambda s: words.select(
        F.col("k1").alias(f"{s}_k1"), F.struct("place", "key").alias(f"{s}_set"), F.col("line").alias(s), F.col("n").alias(f"{s}_n")
    )
    # shared >= similarity * (a_n + b_n - shared), with what is shared made once.
    shared = F.size(F.array_intersect(_words(F.col("a")), _words(F.col("b"))))
    alike = shared * (1 + similarity) >= (F.col("a_n") + F.col("b_n")) * similarity - 1e-9
    later = F.greatest("a_set", "b_set")
    beaten = []
    for now in TURNS:
        todo = pairs.where(now)
        if not todo.limit(1).count():
            break  # no set has so many candidates
        for gone in beaten:
            todo = todo.join(_small(gone), "k1", "left_anti")
        both = todo.drop("k1").join(side("a"), "a_k1").join(side("b"), "b_k1")
        lost = both.where(alike).select(later["key"]["k1"].alias("k1"), later["key"]["k2"].alias("k2")).distinct()
        beaten.append(stored(lost, "lost"))
    if not beaten:
        return classes.select(*_KEY).limit(0)
    return reduce(DataFrame.unionByName, beaten).distinct()


def first_lines(docs: DataFrame, similarity: float) -> DataFrame:
    """(d, h, no) of the lines that stay: no earlier line is similar to them.

    Where many sets share a word of their prefixes, these first meet the
    earliest of them, one pair per set and word; those it does not remove meet
    the earliest of their own, and so on while that removes enough. A set that
    is removed is not tested again, so a large group of variants never yields
    its pairs. The rows of the prefix join are dealt out once, for both sides.
    """
    classes = stored(line_classes(docs, similarity), "lines")
    beaten, served, removed = classes.select(*_KEY).limit(0), None, 0
    while True:
        open_ = classes if not removed else classes.join(_small(beaten), _KEY, "left_anti")
        live = open_.select(*_KEY, *_PLACE, "n", "bits", "far", F.posexplode("prefix").alias("pos", "word"))
        if served is not None:
            live = live.join(_small(served), ["k1", "word"], "left_anti")
        # The least document first: a long is aggregated by hash, a struct is not.
        least = live.groupBy("word").agg(F.min("d").alias("d"), F.count(F.lit(1)).alias("times"))
        least = stored(least.where(F.col("times") >= HOT).select("word", "d"), "hot")
        heads = live.join(_small(least), ["word", "d"]).groupBy("word").agg(
            F.min(F.struct(*_PLACE, "k1", "n", "bits", "far", "pos")).alias("one")
        )
        heads = stored(heads.select("word", "one.*"), "heads")
        star = live.alias("b").join(
            _small(heads).alias("a"),
            (F.col("a.word") == F.col("b.word")) & (F.col("a.k1") != F.col("b.k1")) & _passes(similarity, True),
        )
        new = stored(_beaten(docs, classes, star, similarity), "beaten")
        count = new.count()
        removed += count
        beaten = stored(beaten.unionByName(new), "beaten")
        if count <= removed * GAIN:
            break
        # Those that no head has beaten yet meet the next earliest of them.
        pairs = heads.select("k1", "word")
        served = stored(pairs if served is None else served.unionByName(pairs), "served")
    beaten = stored(beaten.distinct(), "beaten")
    flagged = classes.join(_small(beaten.withColumn("beaten", F.lit(True))), _KEY, "left")
    prefixes = flagged.select(
        "k1", "d", "n", "bits", "far", F.col("beaten").isNotNull().alias("beaten"), F.posexplode("prefix").alias("pos", "word")
    )
    # Only the later set of a pair can be removed by it: a removed one is met only where it may be the earlier.
    may = (~F.col("a.beaten") | ((F.col("a.d") <= F.col("b.d")) & ~F.col("b.beaten"))) & (
        ~F.col("b.beaten") | ((F.col("b.d") <= F.col("a.d")) & ~F.col("a.beaten"))
    )
    meeting = prefixes.alias("a").join(
        prefixes.alias("b"),
        (F.col("a.word") == F.col("b.word"))
        & (F.col("a.k1") < F.col("b.k1"))
        & may
        & _passes(similarity, True),
    )
    late = stored(_beaten(docs, classes, meeting, similarity), "beaten")
    kept = classes.select(*_KEY, *_PLACE)
    for gone in (beaten, late):
        kept = kept.join(_small(gone), _KEY, "left_anti")
    return kept.select(*_PLACE)


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, counts: bool = False) -> DataFrame:
    """``docs`` with their later similar lines removed from ``text``.

    Lines end at a line feed; words stand between ASCII white space. A line is
    removed if an earlier one, removed or not, has a Jaccard similarity of its
    word set of ``similarity`` or more; earlier is a smaller (doc_id, line
    number), rows without a doc_id come last, and rows of one doc_id are
    ordered by a hash of their text. Lines without words always stay, so do
    all documents, if need be with an empty text; NULL text stays NULL.
    Repeated rows are one document: each keeps the same lines. Columns other
    than ``text`` pass through unchanged, whatever their names; ``counts`` adds
    (or puts in their place) n_lines and n_removed.
    """
    plain = _keyed(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    kept = first_lines(plain.where(F.col("text").isNotNull()).select("d", "h", "text"), similarity)
    kept = kept.groupBy("d", "h").agg(F.collect_list("no").alias("kept"))
    # The caller's other columns travel as one, so that none can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = _keyed(docs.select("doc_id", F.col("text").cast("string").alias("text"), row.alias("row")))
    none = F.array().cast("array<int>")
    solid = F.lit(_SPACES.replace("[", "[^"))
    wordless = F.array_compact(F.transform("lines", lambda line, i: F.when(~F.rlike(line, solid), i)))
    # By line number: linear in the lines of a document.
    stays = F.transform(
        F.sort_array(F.array_union(F.coalesce("kept", none), wordless)), lambda i: F.get("lines", i)
    )
    out = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.array_join("stays", "\n")}
    out = {c: out[c] for c in docs.columns}
    if counts:
        out["n_lines"] = F.coalesce(F.size("lines"), F.lit(0))
        out["n_removed"] = F.coalesce(F.size("lines") - F.size("stays"), F.lit(0))
    joined = rows.join(kept, ["d", "h"], "left").withColumn("lines", F.split("text", "\n"))
    return joined.withColumn("stays", stays).select(*[value.alias(name) for name, value in out.items()])

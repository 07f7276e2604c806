"""Line dedup by an exact set-similarity join, in DataFrame operations alone.

A line's tokens are its distinct five-word shingles. A line of one to four words has all its words as its one
token; a line without words has none and stays. Two lines whose Jaccard similarity is at least 4/5 share a token
among the first n - ceil(4n/5) + 1 of the longer and the first n - ceil(8n/9) + 1 of the shorter, in any order of all tokens.
So prefixes are joined twice. The first time the order is that of the hashes of the shingles' first words, and only the shingles in the
prefixes are made: a line that shares none of them with a different line is similar to none. For the lines left, all
tokens are ordered by rarity, by the logarithm of the count of the token's hash bucket over these lines, then by hash. Length and
positional filters and sketches of the sets drop pairs before their token sets are compared. Equal lines are one
node from the start, named by their first place. A line goes if any earlier line, by ``doc_id``, row and line
number, is similar to it, kept or not. To know that, not all pairs are needed: each line first meets
the earliest and the most copied line of its prefix tokens' groups, and only lines that match neither
are joined with all earlier lines of their groups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import durable, free_name, mark, partitions, release, text_or_empty

SHINGLE = 5
BUCKETS = 1 << 16
#: Tokens of buckets with so many times the mean count are grouped by partial aggregates and a join instead of a window.
HOT = 16
_NO_KEY = -(1 << 63)
#: A line with at least five words, once other white space is spaces.
_LONG = rf"^ *(?:[^ ]++ ++){{{SHINGLE - 1}}}[^ ]"
_PLACE = ["key", "row", "no"]


def spaced(text: Column) -> Column:
    """The text with spaces for tab, VT, FF and CR."""
    return F.when(text.rlike("[\t\x0b\f\r]"), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)


def words_of(line: str = "line") -> Column:
    """The words of a line of :func:`spaced` text."""
    return F.array_remove(F.split(line, " "), "")


def is_long(line: str = "line") -> Column:
    """A line of :func:`spaced` text has at least five words; only double spaces among the first need the slower pattern."""
    head = f"substring_index(trim({line}), ' ', {SHINGLE - 1})"
    return F.when(F.expr(f"contains(concat({head}, ' '), '  ')"), F.col(line).rlike(_LONG)).otherwise(F.expr(f"{head} <> trim({line})"))


def word_hashes(line: str = "line") -> Column:
    """The hashes of the words of a line of :func:`spaced` text."""
    return F.transform(words_of(line), lambda w: F.xxhash64(w))


def picked(lines: DataFrame) -> DataFrame:
    """``h, token`` of the shingles of each long line that stand first in the order of their first words' hashes.

    As many different first words as a prefix may have tokens, or all, come with all their shingles. So these are the prefix,
    and a few more where words repeat. Equal lines have one ``h``, and a token twice if its shingle is.
    """
    hashes = lines.where(is_long()).select(F.xxhash64("line").alias("h"), word_hashes().alias("w")).withColumn("k", F.size("w") - (SHINGLE - 1))
    first = F.sort_array(F.array_distinct(F.slice("w", F.lit(1), F.col("k"))))
    hashes = hashes.withColumn("last", F.coalesce(F.get(first, F.expr("cast(k div 5 as int)")), F.lit((1 << 63) - 1)))
    names = [f"w{i}" for i in range(SHINGLE)]
    runs = F.arrays_zip(*(F.slice("w", F.lit(i + 1), F.col("k")).alias(n) for i, n in enumerate(names)))
    return hashes.select("h", "last", F.inline(runs).alias(*names)).where("w0 <= last").select("h", F.xxhash64(*names).alias("token"))


def bucket_counts(tokens: DataFrame) -> list[int]:
    """For each of a fixed number of hash buckets the count of its ``token`` rows."""
    bucket = F.col("token").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")
    out = [0] * BUCKETS
    for row in tokens.groupBy(bucket).count().collect():  # at most BUCKETS rows
        out[row["b"]] = row["count"]
    return out


def not_alone(picks: DataFrame, hot: int, floor: int) -> DataFrame:
    """``h`` of the lines that share one of their ``picks`` with a different line; those with a token of a frequent bucket count as well."""
    counts = bucket_counts(picks)
    most = max(floor, hot * sum(counts) // BUCKETS)
    group, cold, often = Window.partitionBy("token"), picks, None
    if max(counts) >= most:
        flags = F.lit(bytes(48 + (c >= most) for c in counts))
        is_hot = F.substring(flags, F.col("token").bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + 1, F.lit(1)).cast("string") == "1"
        cold, often = picks.where(~is_hot), picks.where(is_hot).select("h")
    met = cold.withColumn("a", F.min("h").over(group)).withColumn("b", F.max("h").over(group)).where("a <> b").select("h")
    return (met if often is None else met.union(often)).distinct()


def rank(count: int) -> int:
    """The logarithm of a bucket's count, as the code of a letter."""
    return 48 + min(75, int(4 * math.log2(count))) if count else 48


def tokens_of(hashes: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``tokens``, the hashes of the distinct shingles of the word hashes ``w`` of long lines."""
    shingle = ", ".join(f"w[i + {k}]" for k in range(1, SHINGLE))
    return hashes.select(*keep, F.expr(f"array_distinct(transform(slice(w, 1, size(w) - {SHINGLE - 1}), (x, i) -> xxhash64(x, {shingle})))").alias("tokens"))


def by_rarity() -> Column:
    """The ``tokens`` as longs in the order of their buckets' ``ranks``."""
    letter = f"shiftleft(cast(ascii(cast(substring(ranks, cast(t & {BUCKETS - 1} as int) + 1, 1) as string)) as bigint), 56)"
    return F.expr(f"sort_array(transform(tokens, t -> {letter} | shiftrightunsigned(t, 8)))")


def later(a: str, b: str) -> str:
    """Line ``a`` stands after line ``b``."""
    return f"({a}key > {b}key OR {a}key = {b}key AND ({a}row > {b}row OR {a}row = {b}row AND {a}no > {b}no))"


def may_match(a: str, b: str) -> str:
    """The filters by length, and by place: what stands before a shared token in either line and after it bounds what they share."""
    length = f"5 * {b}n >= 4 * {a}n AND 5 * {a}n >= 4 * {b}n"
    return f"{length} AND 9 * (least({a}pos, {b}pos) + least({a}n - {a}pos, {b}n - {b}pos)) >= 4 * ({a}n + {b}n)"


def in_short_prefix(a: str, b: str) -> str:
    """The shared token is among the first n - ceil(8n/9) + 1 of the line with fewer tokens."""
    return f"CASE WHEN {a}n < {b}n OR {a}n = {b}n AND {later(b, a)} THEN 9 * {a}pos <= {a}n ELSE 9 * {b}pos <= {b}n END"


def in_sketch(a: str, b: str) -> str:
    """No more bits of the lines' sketches differ than tokens may."""
    return f"9 * (bit_count({a}sketch ^ {b}sketch) + bit_count({a}other ^ {b}other)) <= {a}n + {b}n"


def candidates(met: DataFrame) -> DataFrame:
    """The pairs ``key, row, no, okey, orow, ono`` that the tokens met in both prefixes leave possible.

    All tokens that two lines share up to the last one met are among those met; after it, the rest of the
    shorter remainder could be shared at most. That is the positional filter at its tightest.
    """
    pairs = met.groupBy(*_PLACE, *("o" + c for c in _PLACE), "n", "on").agg(F.count("*").alias("k"), F.max(F.struct("pos", "opos")).alias("last"))
    return pairs.where("9 * (k + least(n - last.pos, on - last.opos) - 1) >= 4 * (n + on)").select(*_PLACE, *("o" + c for c in _PLACE))


def similar(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The later lines ``key, row, no`` of those pairs ``key, row, no, okey, orow, ono`` whose token sets are similar."""
    mine = tokens.select(*_PLACE, F.col("tokens").alias("t"))
    theirs = tokens.select(*(F.col(c).alias("o" + c) for c in _PLACE), F.col("tokens").alias("o"))
    both = pairs.join(mine, _PLACE).join(theirs, ["o" + c for c in _PLACE])
    shared = F.size(F.array_intersect("t", "o"))
    return both.where(5 * shared >= 4 * (F.size("t") + F.size("o") - shared)).select(*_PLACE).distinct()


def shared_ids(docs: DataFrame) -> bytes:
    """For each of a fixed number of hash buckets whether a ``doc_id`` in it has more than one text, as one letter."""
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("h"))
    several = ids.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b")
    out = bytearray(b"0" * BUCKETS)
    for row in several.select(F.expr(f"cast(xxhash64(key) & {BUCKETS - 1} as int)").alias("b")).distinct().collect():  # at most BUCKETS rows
        out[row["b"]] = 49
    return bytes(out)


def keyed_copy(docs: DataFrame, key: str, row: str) -> DataFrame:
    """``docs`` with their key and row, written once to the shared folder in buckets of both.

    The row tells the texts of one ``doc_id`` apart by their hash, and rows without a ``doc_id`` by a number of
    their own. It is zero where the ``doc_id`` has one text, but for few that meet a shared one in a hash bucket.
    The passes that join the texts with what is known of their lines then shuffle no text.
    """
    flags = F.lit(shared_ids(docs))
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_KEY)))
    spot = F.xxhash64(key).bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + 1
    shared = F.substring(flags, spot, F.lit(1)).cast("string") == "1"
    number = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).when(shared, F.xxhash64("text")).otherwise(F.lit(0))
    return durable(keyed.withColumn(row, number), key, row)


def groups_of(prefixes: DataFrame, hot_rank: int) -> DataFrame:
    """``token, key, row, no, n, pos`` of the prefix rows whose token has more than one line, with ``early``, its first line, and ``common``, its most copied one.

    One exchange deals all rows by their token, frequent ones by a salt as well. Those are then brought together by partial
    aggregates and a join, which no single task has to read.
    """
    number, size, spot = "cast(shiftright({0}x, 32) as int)", "cast({0}x & 4294967295 as int)", "cast(shiftright({0}y, 8) as int)"

    def unpacked(of: str = "") -> list[Column]:
        return [F.col(f"{of}key"), F.col(f"{of}row"), F.expr(number.format(of)).alias("no"), F.expr(size.format(of)).alias("n"), F.expr(spot.format(of)).alias("pos")]

    hot = F.expr(f"shiftright(token, 56) >= {hot_rank}")
    salt = F.when(hot, F.pmod(F.xxhash64("key", "row", "x"), F.lit(partitions(prefixes.sparkSession)))).otherwise(0)
    group, line = Window.partitionBy("token", "salt"), F.struct("key", "row", "x", "y")
    most = F.max(F.struct(F.expr("y & 255").alias("c"), line.alias("p")))
    # the count first: most tokens have one line, and what the other windows need is not made before the exchange
    met = prefixes.withColumn("salt", salt).withColumn("lines", F.count("*").over(group)).where((F.col("lines") > 1) | hot)
    met = met.withColumn("early", F.min(line).over(group)).withColumn("most", most.over(group))
    met = met.select(
        "token", *unpacked(), F.struct(*unpacked("early.")).alias("early"), F.struct("most.c", F.struct(*unpacked("most.p.")).alias("p")).alias("most"), hot.alias("hot")
    )
    met = durable(met)
    own = ["token", *_PLACE, "n", "pos"]
    cold = met.where("NOT hot").select(*own, "early", F.col("most.p").alias("common"))
    if not met.where("hot").limit(1).count():
        return cold
    stats = met.where("hot").groupBy("token").agg(F.count("*").alias("lines"), F.min("early").alias("early"), F.max("most").getField("p").alias("common"))
    return durable(cold.unionByName(met.where("hot").select(*own).join(stats.where("lines > 1").drop("lines"), "token")))


def lasting_lines(copy: DataFrame, hot: int = HOT, floor: int = 10_000) -> DataFrame:
    """``key, row, no`` of the lines with words of :func:`keyed_copy` that stay; ``key`` is the ``doc_id``, with nulls before all."""
    rows = copy.select("key", "row", spaced(text_or_empty()).alias("text"))
    lines = rows.select("key", "row", F.posexplode(F.split("text", "\n")).alias("no", "line"))

    # equal lines: the first place stands for all
    same = F.when(is_long(), F.col("line")).otherwise(F.array_join(words_of(), " "))
    named = lines.where("trim(line) <> ''").select(*_PLACE, is_long().alias("long"), F.xxhash64(same).alias("h"), F.xxhash64(F.lit("#"), same).alias("g"))
    firsts = named.groupBy("h", "g", "long").agg(F.min(F.struct(*_PLACE)).alias("f"), F.count("*").alias("copies"))
    log_copies = F.floor(F.log2(F.col("copies").cast("double"))).cast("int")
    firsts = durable(firsts.select("f.*", "long", "h", log_copies.alias("c")))

    def lines_at(wanted: DataFrame) -> DataFrame:
        """``key, row, no, c, words`` of the ``wanted`` lines, read by one join of each document with all of its own."""
        spots = wanted.groupBy("key", "row").agg(F.collect_set(F.struct("no", "c")).alias("spots"))  # of one document
        found = rows.join(spots, ["key", "row"]).select("key", "row", "spots", F.split("text", "\n").alias("lines"))
        found = found.select("key", "row", F.expr("inline(transform(spots, s -> struct(s.no AS no, s.c AS c, lines[s.no] AS line)))"))
        return found.select(*_PLACE, "c", word_hashes().alias("w"))

    # lines that share nothing with another in a prefix are settled; of the others all tokens are made, and only here
    own = mark()
    left = durable(not_alone(durable(picked(lines)), hot, floor))
    release(copy.sparkSession, own, but=1)
    wanted = firsts.where("long").join(left, "h", "left_semi").select(*_PLACE, "c")
    # a sketch, of two longs, has a bit flipped for each token, so that two differ in at most as many bits as the lines do in tokens
    sketch, other = (F.expr(f"aggregate(tokens, 0L, (s, t) -> s ^ if(t & 64 = {k}, shiftleft(1L, cast(t & 63 as int)), 0L))") for k in (0, 64))
    made = tokens_of(lines_at(wanted), *_PLACE, "c").withColumn("sketch", sketch).withColumn("other", other)
    tokens = durable(made.repartition(partitions(copy.sparkSession), *_PLACE), *_PLACE)
    counts = bucket_counts(tokens.select(F.explode("tokens").alias("token")))
    hot_rank = rank(max(floor, hot * sum(counts) // BUCKETS))

    # the first places' prefixes; a row is five longs: the token, the document's key and row, the line's
    # number and size, and the token's place and the logarithm of the line's copies
    ranked = tokens.withColumn("ranks", F.lit(bytes(map(rank, counts)))).select(*_PLACE, "c", F.size("tokens").alias("n"), by_rarity().alias("tokens"))
    first_part = F.slice("tokens", F.lit(1), F.expr("n - cast((4 * n + 4) div 5 as int) + 1"))
    prefixes = ranked.select(*_PLACE, "c", "n", F.posexplode(first_part).alias("pos", "token"))
    line_and_size = F.shiftleft(F.col("no").cast("long"), 32).bitwiseOR(F.col("n").cast("long"))
    place_and_copies = F.shiftleft(F.col("pos").cast("long"), 8).bitwiseOR(F.col("c").cast("long"))
    met = groups_of(prefixes.select("token", "key", "row", line_and_size.alias("x"), place_and_copies.alias("y")), hot_rank)

    leaders = met.select(*_PLACE, "n", "pos", F.explode(F.array_distinct(F.array("early", "common"))).alias("o"))
    leaders = leaders.select(*_PLACE, "n", "pos", "o.*").toDF(*_PLACE, "n", "pos", "okey", "orow", "ono", "on", "opos")
    led = durable(similar(candidates(leaders.where(f"{later('', 'o')} AND {may_match('', 'o')}")), tokens))
    own = ["token", *_PLACE, "n", "pos", "sketch", "other"]
    marked = met.select(*own[:-2]).join(tokens.select(*_PLACE, "sketch", "other"), _PLACE)
    rest = marked.join(led, _PLACE, "left_anti").select(*own)
    others = marked.select("token", *(F.col(c).alias("o" + c) for c in own[1:]))
    filters = (later("", "o"), may_match("", "o"), in_short_prefix("", "o"), in_sketch("", "o"))
    pairs = rest.join(others, F.expr(" AND ".join(filters)) & (rest["token"] == others["token"]))
    gone = led.union(similar(candidates(pairs), tokens))
    return firsts.select(*_PLACE).join(gone, _PLACE, "left_anti")


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, its texts without their repeated lines, and ``_n_lines``, ``_n_removed``.

    Lines are what ``\\n`` separates; blank ones stay. Lines of one to four words go where an earlier line has the same
    words, longer ones where an earlier one is similar. A null text stays null and has no lines; an empty one has one. Rows of
    one ``doc_id`` with different texts are different documents, ordered by a hash; equal rows count as one
    document and lose the same lines. Rows without a ``doc_id`` are each a document and stand before all others. An empty
    table gives an empty result. Columns of ``docs`` named ``_n_lines`` or ``_n_removed`` are replaced; any other
    name is safe. The result reads a copy of ``docs`` in the shared folder, until :func:`common.release`; the other
    intermediate tables go before this returns, or when it fails.
    """
    spark, began = docs.sparkSession, mark()
    columns = [c for c in docs.columns if c.lower() not in ("_n_lines", "_n_removed")]
    docs = docs.select(*(F.col(f"`{c}`") for c in columns))
    key, row = free_name(docs, "_dedup_key"), free_name(docs, "_dedup_row")
    try:
        copy = keyed_copy(docs, key, row)
        own = mark()
        lasting = lasting_lines(copy.select(F.col(key).alias("key"), F.col(row).alias("row"), "text"))
        lasting = durable(lasting.groupBy("key", "row").agg(F.collect_set("no").alias("nos")))  # of one document
        release(spark, own, but=1)
    except BaseException:
        release(spark, began)
        raise
    nos, lines, stay = (free_name(docs, n) for n in ("_dedup_nos", "_dedup_lines", "_dedup_stay"))
    found = copy.join(lasting.toDF(key, row, nos), [key, row], "left").withColumn(lines, F.split(F.col("text").cast("string"), "\n"))
    blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~F.get(lines, i).rlike("[^ \t\x0b\f\r]"))
    found = found.withColumn(stay, F.when(F.col(lines).isNotNull(), F.sort_array(F.concat(blank, F.coalesce(nos, F.array().cast("array<int>"))))))
    left = F.array_join(F.expr(f"transform(`{stay}`, i -> `{lines}`[i])"), "\n")
    total, less = (F.coalesce(F.when(F.col(lines).isNotNull(), F.size(lines) - n), F.lit(0)).cast("long") for n in (F.lit(0), F.size(stay)))
    text = F.when(F.size(stay) < F.size(lines), left).otherwise(F.col("text").cast("string"))
    found = found.withColumn("_n_lines", total).withColumn("_n_removed", less)
    return found.withColumn("text", text).select(*(F.col(f"`{c}`") for c in columns), "_n_lines", "_n_removed")

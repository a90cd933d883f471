"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

Lines that occur again, exactly or with few edits, are dropped: of equal lines
the first occurrence (by document id, then line number) stays, and a line goes
altogether if a line that first occurs earlier is near it. Two lines are near if
they are at most one edit per 64 characters of the shorter apart, or one edit if
that has fewer than 128; ``edits`` puts one number in place of this for lines of
any length. A line is compared with every earlier one, whether or not that one
stays, so the result does not depend on an order of work.

Equal lines are merged first by a 128-bit hash, with map-side combine and without
their texts, so a line that stands in a third of all documents is one row. For one
number of edits (lines of fewer than 128 characters, or any with ``edits``) the join
splits a line into ``edits + 1`` segments: of two lines within ``edits`` edits, one
segment of the shorter (or either, if equally long) stands unchanged in the longer, at
a place that the edits before and after it allow. So a line has as keys the hashes of
length, segment number and segment, and of the substrings at those places. For E >= 2
edits blocks of 32 characters take the place of the segments, h + 1 from the start of
the line and as many from its end, where h is half of E: one half of the shorter line
has at most h edits, and so a block k unchanged before which (from that end) at most k
edits are. Such a block stands at most k characters off in the other line. Both lines
take substrings of a block at the marks of a sparse ruler, of which two are any
distance up to k apart, so that a pair of marks meets; each substring ends within its
block. Blocks have 32 characters, and 56 from lines of 1024 on. From 4096 characters on
lines meet by the 28-grams at the places whose number modulo 31 is one of six, of which
two are any number apart: E edits leave a run of 58 characters unchanged, and in it,
whatever its shift, a gram that both lines take. No pair is missed by either.

Keys are made once, of the first occurrences of lines (of the most frequent ones, where not all
may be broadcast), and shuffled with the line hash alone; those that two different lines hold stay. Keys of more than
``CHUNK`` lines are dealt out: their lines fall in parts of about that size, and each
pair of parts is a unit of its own in the join, so that no task has a whole key.

One earlier line that is near settles a line. So of a few neighbours in each key (in its
part), in an order that differs from key to key, a line takes the earlier ones that its
counts show as the nearest: it is compared with the first of them, then,
as long as that settles nothing, with the next ones; only the lines that this leaves meet
all earlier ones of their keys. Two lines of many keys meet
once: for each of ``BINS`` classes of keys a line's least key goes along, and the first
class in which both have the same one says by which key they meet (if there is none, by
each they share).

The join's condition also compares the lines' lengths, their counts of 15 letters and
of all other characters (modulo 16), which E edits change by at most 2 E in sum, less what the
lengths differ, and for one edit their signatures,
which bound the characters that both have at the start and at the end (all but one);
so variants of a line that share a key but differ more are not listed as pairs. Pairs
for one number of edits are verified by a banded bit-parallel automaton: register e
holds, a bit for each diagonal of the band, what e edits reach. Its band is fixed in
the plan, so pairs whose edits follow their length go through Spark's own banded
``levenshtein``.

Defined cases: NULL texts have no lines and stay NULL; blank lines are never
compared and stay; lines shorter than ``min_chars`` are compared exactly only;
rows that repeat an id and its text are one document and get the same result;
NULL ids come last in the order; documents that share an id or have none come, line
number by line number, in the order of a hash of id and text, so one occurrence stays; other columns are kept by ``clean``, with
their names (``clean`` refuses no name but the text's own); an empty table
gives no rows. Very long lines and texts are processed whole.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import materialise

MIN_CHARS = 16
PER_EDIT = 64  # characters for which one edit is allowed
BROADCAST_LINES = 1_000_000  # hashes of 8 bytes
CHUNK = 512  # lines of a part of a crowded key

FEW = 16  # from so many allowed edits on a part of them is tried first
NEIGHBOURS = 12  # lines of a key, on both sides of a line, that it may be compared with first
TRIES = (0, 1, 8, 2 ** 31 - 1)  # bounds of the rounds in which it is compared with those of all its keys
STRIPS = (16384, 4096, 2048, 1024, 512, 256, 128, 64, 32, 16)  # characters that a pair may lose at an end, each once
BINS = 8  # key classes of which a line's least keys are compared

# The letters whose counts are compared, eight to a number; the last count is of all other characters.
LETTERS = ("etaionrs", "hdlucmf")
# Counts modulo 16, of which as many bits differ as they are apart on a circle of 16.
CIRCLE = [2 ** n - 1 for n in range(9)] + [255 - (2 ** n - 1) for n in range(1, 8)]

# Follow from PER_EDIT: from SEVERAL characters on 2 edits are allowed and more. The h + 1 blocks from an end of a
# line with E edits, h half of E, lie in its half: BLOCK * (h + 1) <= 32 E, from WIDE characters on WIDE_BLOCK * (h + 1) <= 32 E.
# From LONG on E edits leave a run of PERIOD + GRAM - 1 <= 63 E / (E + 1) characters.
SEVERAL = 2 * PER_EDIT
BLOCK, WIDE, WIDE_BLOCK = 32, 1024, 56
LONG = 4096
HALVES = -1  # in place of a block's size
# Sparse rulers: any distance up to the last mark is one of two marks.
RULERS = ((0,), (0, 1), (0, 1, 3), (0, 1, 4, 6), (0, 1, 2, 6, 9), (0, 1, 2, 6, 10, 13), (0, 1, 2, 3, 8, 13, 17),
          (0, 1, 2, 11, 15, 18, 21, 23), (0, 1, 2, 14, 18, 21, 24, 27, 29), (0, 1, 3, 6, 13, 20, 27, 31, 35, 36))
# Residues modulo 31 of which two are any number apart (a perfect difference set); PERIOD + GRAM - 1 characters hold them all.
COVER, PERIOD, GRAM = (0, 1, 3, 8, 12, 18), 31, 28
BLANKS = " \t\r\f\v"
SIDE, SIDES = 8, 15  # characters and number of the blocks of a line's signature from either end

_LAST_ID = 2 ** 63 - 1


def segment(length: Column, parts: int, k: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``k`` of a line: the last ones are longer by one."""
    base = F.floor(length / parts).cast("int")
    longer = length % parts
    short = parts - longer  # segments of the base length
    return base * k + F.greatest(F.lit(0), k - short), base + F.when(k >= short, 1).otherwise(0)


def _key(length: Column, k: int, line: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(k), length.cast("int"), F.substring(line, start + 1, size))


def allowed(chars: Column) -> Column:
    """The edits that are allowed where the shorter line has so many characters."""
    return F.greatest(F.lit(1), F.floor(chars / PER_EDIT).cast("int"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not at each use in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def ruler(k: int) -> tuple[int, ...]:
    """The marks for distances up to ``k``."""
    return next(marks for marks in RULERS if marks[-1] >= k)


def _last(longest: int) -> int:
    """The last block of lines that can be near one of fewer than ``longest`` characters."""
    return (longest + longest // PER_EDIT) // PER_EDIT // 2


def place_keys(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """lid1, key: the keys of lines (lid1, line, chars): of halves for one edit, of blocks and grams for several."""
    chars, size, block = F.col("chars"), F.col("size"), F.col("block")
    below = lambda bound: chars - F.col("most") < bound  # noqa: E731 - can be near a line of fewer characters
    # Four bytes a character, so that a piece is cut out wherever it stands without a walk to it.
    lines = rows.select("lid1", "chars", F.encode("line", "UTF-32").alias("text"), allowed(chars).alias("most"))
    # A row for each way a line can meet others: by halves, by blocks of some size, or (size 0) by grams.
    ways = F.array(F.when(chars <= SEVERAL, HALVES), F.when((chars >= SEVERAL) & below(WIDE), BLOCK),
                   F.when((chars >= WIDE) & below(LONG), WIDE_BLOCK), F.when(chars >= LONG, 0))
    lines = lines.select("*", F.explode(ways).alias("size")).where(size.isNotNull())
    # A row a half (two for the line's own length, two for one less), a block (-1 - k is the k-th from the end) or a period.
    # Of E edits at most E // 2 are in the shorter line's first half, or at most (E - 1) // 2 in its second.
    half = lambda n: F.shiftright(n, 1)
    first = F.when(size > 0, -1 - half(F.col("most") - 1)).otherwise(0)
    last = F.when(size > 0, half(F.col("most"))).when(size == 0, F.floor((chars - GRAM) / PERIOD).cast("int")).otherwise(3)
    blocks = lines.select("*", F.explode(F.sequence(first, last)).alias("block"))
    rulers = [ruler(k) for k in range(_last(LONG) + 1)]
    k = F.when(block < 0, -1 - block).otherwise(block)
    numbers = lambda found: F.array(*map(F.lit, found))
    marks = F.when(size > 0, F.get(F.array(*map(numbers, rulers)), k)).when(size == 0, numbers(COVER)).otherwise(numbers((0,)))
    less, second = half(block), block % 2 == 1
    length = chars - less
    at = F.when(size > 0, block * size + F.when(block < 0, chars).otherwise(0)).when(size == 0, block * PERIOD)
    at = at.otherwise(F.when(second, half(length) + less).otherwise(0))
    taken = F.when(size > 0, size - F.get(numbers(r[-1] for r in rulers), k)).when(size == 0, GRAM)
    taken = taken.otherwise(F.when(second, length - half(length)).otherwise(half(length)))
    # Halves meet where the shorter line has the same length, blocks and halves by their number.
    tag = F.when(size > 0, block).when(size == 0, 0).otherwise(length * 2 + F.when(second, 1).otherwise(0) + SEVERAL)
    inside = (size != HALVES) | ((length >= min_chars) & (length < SEVERAL))
    cut = blocks.where(inside).select("lid1", "text", tag.alias("tag"), at.alias("at"), taken.alias("taken"), marks.alias("marks"))
    cut = cut.select("lid1", "text", "tag", "taken", "at", F.explode("marks").alias("mark"))
    start, wide = F.col("at") + F.col("mark"), F.col("taken")
    return cut.where((start + wide) * 4 <= F.octet_length("text")).select(
        "lid1", F.xxhash64("tag", F.substring("text", start * 4 + 1, wide * 4)).alias("key"))


def segment_keys(line: Column, chars: Column, edits: int, min_chars: int) -> list[Column]:
    """The keys of a line's own segments, and those under which lines of a lesser length can find it;
    NULL where a place is outside the line."""
    found = []
    for less in range(edits + 1):
        length = chars - less
        for k in range(edits + 1):
            start, size = segment(length, edits + 1, k)
            first = max(-k, less - (edits - k))
            last = min(k, less + (edits - k))
            for shift in range(first, last + 1):
                at = start + shift
                inside = (length >= min_chars) & (at >= 0) & (at + size <= chars)
                found.append(F.when(inside, _key(length, k, line, at, size)))
    return found


def letter_counts(line: Column, chars: Column) -> list[Column]:
    """Counts of 15 letters and of the other characters as places on a circle, packed in longs."""
    # Bytes tell as much as characters, the letters being ASCII, and need no pass over the line.
    bare = [[F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in group] for group in LETTERS]
    bare[-1].append(chars - reduce(add, [n for group in bare for n in group]))
    circle = F.array(*[F.lit(n).cast("long") for n in CIRCLE])
    return [reduce(add, [F.shiftleft(F.get(circle, n % 16), 8 * i) for i, n in enumerate(group)]) for group in bare]


def counts_apart(a: Column, b: Column) -> Column:
    """A lower bound of how far eight counts of two lines are apart, in sum."""
    return F.bit_count(a.bitwiseXOR(b))


def signature(start: Column) -> Column:
    """Four bits of the hash of each of the first ``SIDES`` blocks of ``SIDE`` characters, in a long."""
    def bits(text: Column, k: Column) -> Column:
        hashed = F.pmod(F.xxhash64(F.substring(text, k * SIDE + 1, F.lit(SIDE))), F.lit(16))
        return F.call_function("shiftleft", hashed, 4 * k)

    return _let(start, lambda text: F.aggregate(
        F.sequence(F.lit(0), F.lit(SIDES - 1)), F.lit(0).cast("long"), lambda packed, k: packed + bits(text, k)))


def alike(a: Column, b: Column) -> Column:
    """An upper bound of the characters that two lines have in common from one end, given their signatures."""
    differ = a.bitwiseXOR(b)
    blocks = F.floor(F.bit_count(differ.bitwiseAND(-differ) - 1) / 4)  # the blocks before the first that differs
    return F.when(differ == 0, 2 ** 31 - 1).otherwise(blocks * SIDE + (SIDE - 1))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines, given as arrays of characters, are at most ``edits`` edits apart.

    After j characters of ``b``, bit d of register e says that e edits align
    them with the first j + d - edits characters of ``a``. A step keeps a
    diagonal on a match or a substitution, goes to the one below on an
    insertion and to the one above on a deletion.
    """
    width = 2 * edits + 1
    band = F.lit((1 << width) - 1)
    registers = [f"r{e}" for e in range(edits + 1)]
    start = F.struct(*[F.lit(((1 << (e + 1)) - 1) << edits & ((1 << width) - 1)).alias(r)
                       for e, r in enumerate(registers)])

    def step(state: Column, j: Column) -> Column:
        char = F.get(b, j)
        match = reduce(add, [F.when(F.get(a, j + (d - edits)) == char, 1 << d).otherwise(0) for d in range(width)])
        after = [state["r0"].bitwiseAND(match)]
        for e in range(1, edits + 1):
            fewer = state[f"r{e - 1}"]
            # The registers are nested, so one of fewer edits is part of the next.
            moved = fewer.bitwiseOR(F.shiftright(fewer, 1)).bitwiseOR(F.shiftleft(after[e - 1], 1))
            after.append(state[f"r{e}"].bitwiseAND(match).bitwiseOR(moved).bitwiseAND(band))
        return F.struct(*[x.alias(r) for x, r in zip(after, registers, strict=True)])

    longer = F.size(a) - F.size(b)
    steps = F.when(F.size(b) > 0, F.sequence(F.lit(0), F.size(b) - 1)).otherwise(F.array().cast("array<int>"))
    end = F.aggregate(steps, start, step, lambda state: state[f"r{edits}"])
    return (F.abs(longer) <= edits) & (F.shiftright(end, 0).bitwiseAND(
        F.pow(F.lit(2), F.greatest(longer, F.lit(-edits)) + edits).cast("int")) != 0)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a 128-bit key of id and text."""
    return docs.withColumns({f"__k{n}": F.xxhash64(F.lit(n), F.col(id_col), F.col(text_col)) for n in (1, 2)})


def _lines(keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k1, k2, id (NULL ids come last), line_no, line, lid1, lid2 (hashes of the line)."""
    rows = keyed.where(F.col(text_col).isNotNull()).select(
        F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    return rows.select("k1", "k2", "id", "line_no", "line",
                       F.xxhash64(F.lit(1), "line").alias("lid1"), F.xxhash64(F.lit(2), "line").alias("lid2"))


def _place() -> Column:
    """An order of all lines: id, line number and 32 bits of k2 in one number, which a hash aggregate can hold."""
    place = (F.col("id").cast("decimal(19,0)") * F.lit(2 ** 31).cast("decimal(10,0)")
             + F.col("line_no").cast("decimal(10,0)")).cast("decimal(30,0)")
    return (place * F.lit(2 ** 32).cast("decimal(10,0)")
            + F.pmod("k2", F.lit(2 ** 32)).cast("decimal(10,0)")).cast("decimal(38,0)")


def _keys(lines: DataFrame, edits: int | None, min_chars: int) -> DataFrame:
    """key, lid1: the keys of all lines; lines that occur again have them again."""
    rows = lines.select("lid1", "line", F.length("line").alias("chars")).where(F.col("chars") >= min_chars)
    line, chars = F.col("line"), F.col("chars")
    if edits is not None:
        found = F.array(*segment_keys(line, chars, edits, min_chars))
        return rows.select("lid1", F.explode(found).alias("key")).where(F.col("key").isNotNull())
    return place_keys(rows, min_chars)


def _broadcast(rows: DataFrame, bound: int) -> DataFrame:
    """A written table as the small side of a join: broadcast for a checked number of rows, by shuffle beyond."""
    return F.broadcast(rows) if rows.count() <= bound else rows


def _dealt(sized: DataFrame) -> DataFrame:
    """``sized`` with the number of parts of its key, NULL where a line's neighbours are all the others, and the line's part."""
    most = NEIGHBOURS // 2 + 1  # lines of a key that all see each other
    many = sized.where(F.col("rows") > most).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    many = materialise(many.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts")), "crowded")
    dealt = sized.join(_broadcast(many, BROADCAST_LINES), "key", "left")
    return dealt.withColumn("part", F.pmod(F.xxhash64("lid1"), F.coalesce("parts", F.lit(1))).cast("int"))


def _least_apart(a, b) -> Column:
    """A lower bound of twice the edits that two lines are apart; ``a`` and ``b`` give their columns."""
    # Every character is counted once: an edit changes two counts by one, or one and the length.
    return reduce(add, [counts_apart(a(f"letters{i}"), b(f"letters{i}")) for i in range(len(LETTERS))], F.abs(a("chars") - b("chars")))


def _may_be_near(a, b, edits: int | None) -> Column:
    """Whether two lines may be near by length, letters and signatures; ``a`` and ``b`` give their columns."""
    shorter, apart = F.least(a("chars"), b("chars")), F.abs(a("chars") - b("chars"))
    least = F.lit(edits) if edits is not None else allowed(shorter)
    # One edit leaves all but one character of the shorter line in what both have at the start and at the end.
    one = (least != 1) | (alike(a("head"), b("head")) + alike(a("tail"), b("tail")) >= shorter - 1)
    return (apart <= least) & (_least_apart(a, b) <= 2 * least) & one


def _neighbours(dealt: DataFrame, edits: int | None) -> DataFrame:
    """lid1, others: for each line the earlier ones that it is compared with first, the likeliest to be near in front.

    In a part of a key a line sees the ``NEIGHBOURS`` around it, in one row. The order is another one for each key, so a line of
    many keys has many neighbours; lines that have a class's least key in common stand together. Of a key whose parts are NULL
    these are all pairs.
    """
    carried = ["lid1", "chars", "order", "head", "tail", *[f"letters{i}" for i in range(len(LETTERS))]]
    least = F.get(F.array(*[f"least{i}" for i in range(BINS)]), F.pmod(F.xxhash64("key"), F.lit(BINS)).cast("int"))
    # Lines whose orders are the same double may be either way round.
    earlier = lambda b: b.isNotNull() & (b["order"] <= F.col("order")) & (b["lid1"] != F.col("lid1")) & _may_be_near(F.col, b.getField, edits)
    # Of a very long line some of the keys of many lines are enough for this.
    some = F.col("parts").isNull() | (F.pmod(F.xxhash64(F.lit("some"), "key"), F.ceil(F.col("chars") / LONG)) == 0)

    def seen(dealt: DataFrame, reach: int) -> DataFrame:
        order = Window.partitionBy("key", "part").orderBy(F.xxhash64("key", least), F.xxhash64("key", "lid1"))
        row = F.struct(*carried)
        beside = F.array(*[side(row, n + 1).over(order) for n in range(reach) for side in (F.lag, F.lead)])
        taken = F.transform(F.filter("beside", earlier), lambda b: F.struct(_least_apart(F.col, b.getField).alias("apart"), b["lid1"].alias("other")))
        rows = dealt.select("key", "parts", *carried, beside.alias("beside")).where(some)
        return rows.select("lid1", taken.alias("taken")).where(F.size("taken") > 0)

    # Most keys have two lines, of which each has the other beside it.
    rows = seen(dealt.where(F.col("rows") == 2), 1).union(seen(dealt.where(F.col("rows") > 2), NEIGHBOURS // 2))
    found = F.array_distinct(F.array_sort(F.flatten(F.collect_list("taken")))["other"])
    return rows.groupBy("lid1").agg(found.alias("others"))


def _pairs(dealt: DataFrame, seekers: DataFrame, edits: int | None) -> DataFrame:
    """The pairs (a, b), each once, of a line of ``seekers`` and an earlier one that may be near and share a key of several parts or one.

    The pairs of the other keys are among the neighbours.
    """
    dealt = dealt.where(F.col("parts").isNotNull())
    columns = [c for c in dealt.columns if c not in ("key", "rows", "part", "parts")]
    # A unit is two parts of a key, or a part with itself.
    left = dealt.join(seekers, "lid1", "left_semi").select(
        "key", F.col("part").alias("u"), F.explode(F.expr("sequence(0, parts - 1)")).alias("v"),
        *[F.col(c).alias(f"{c}_a") for c in columns])
    right = dealt.select("key", F.explode(F.expr("sequence(0, parts - 1)")).alias("u"), F.col("part").alias("v"),
                         *[F.col(c).alias(f"{c}_b") for c in columns])
    a, b = (lambda c: F.col(f"{c}_a")), (lambda c: F.col(f"{c}_b"))
    # Lines that have the least key of a class in common meet by that key only.
    least = [F.when(a(f"least{i}") == b(f"least{i}"), a(f"least{i}")) for i in range(BINS)]
    once = F.col("key") == F.coalesce(*least, F.col("key"))
    # A double orders places well enough: where two are the same the pair is met from both sides.
    met = left.join(right, ["key", "u", "v"]).where((a("lid1") != b("lid1")) & (a("order") >= b("order")) & _may_be_near(a, b, edits) & once)
    return met.select(F.least(a("lid1"), b("lid1")).alias("a"), F.greatest(a("lid1"), b("lid1")).alias("b")).distinct()


def stripped(a: Column, b: Column) -> Column:
    """Two lines as a struct, less what both have at the start and at the end, in steps of ``STRIPS``, and reversed.

    That leaves their distance as it is, and its time grows with the square of their length.
    """
    both = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    # Bytes are counted at once, characters one by one. Two lines that differ have no more equal characters than the shorter.
    long = lambda p, size: (F.octet_length(p["a"]) >= size) & (F.octet_length(p["b"]) >= size)
    cut = lambda p, size: F.when(
        long(p, size) & (F.left(p["a"], size) == F.left(p["b"], size)), both(F.substr(p["a"], size + 1), F.substr(p["b"], size + 1))).otherwise(p)
    sizes = F.array(*map(F.lit, STRIPS))
    # The end is the start of the reversed lines, which are as far apart.
    return _let(F.aggregate(sizes, both(a, b), cut), lambda p: F.aggregate(sizes, both(F.reverse(p["a"]), F.reverse(p["b"])), cut))


def starts_near(p: Column, share: int, most: Column) -> Column:
    """Whether the first one in ``share`` characters of two lines are as near as they must be in lines within ``most`` edits.

    Where the edits put as many characters more in b's start as in a's, they put them less in its rest, or the lengths differ.
    So they are as many, with those that cut the starts to one length, as ``most`` and what the lengths differ, at the most.
    """
    chars = F.floor(F.least(F.length(p["a"]), F.length(p["b"])) / share).cast("int")
    bound = most + F.abs(F.length(p["a"]) - F.length(p["b"]))
    return F.call_function("levenshtein", F.left(p["a"], chars), F.left(p["b"], chars), bound) >= 0


def _verified(pairs: DataFrame, texts: DataFrame, edits: int | None) -> DataFrame:
    """lid1, lid2 of the later lines of the pairs that are near."""
    sides = [texts.select(F.col("lid1").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("lid2", "place", "line")])
             for s in ("a", "b")]
    # Of the texts only those of pairs are shuffled.
    named = _broadcast(pairs, BROADCAST_LINES)
    rows = sides[0].join(named, "a").join(sides[1].join(named.select("b").distinct(), "b", "left_semi"), "b")
    near = _let(F.split("line_a", ""), lambda a: _let(F.split("line_b", ""), lambda b: within(a, b, 1 if edits is None else edits)))
    if edits is None:
        most = allowed(F.least(F.length("line_a"), F.length("line_b")))
        distance = lambda p, bound: F.call_function("levenshtein", p["a"], p["b"], bound) >= 0
        # The time grows with the bound: long lines are often much nearer than they may be.
        several = _let(stripped(F.col("line_a"), F.col("line_b")), lambda p: F.when(most < FEW, distance(p, most)).otherwise(
            distance(p, F.floor(most / FEW).cast("int")) | (starts_near(p, 8, most) & starts_near(p, 2, most) & distance(p, most))))
        near = F.when(most == 1, near).otherwise(several)
    close = rows.where(near)
    later = F.col("place_a") > F.col("place_b")
    return close.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("lid1"),
                        F.when(later, F.col("lid2_a")).otherwise(F.col("lid2_b")).alias("lid2")).distinct()


def _seekers(texts: DataFrame, near: DataFrame) -> DataFrame:
    """lid1 of the lines that are not among those found ``near`` an earlier one."""
    left = texts.join(near, ["lid1", "lid2"], "left_anti").select("lid1").distinct()
    return _broadcast(materialise(left, "seekers"), BROADCAST_LINES)


def _near_lines(lines: DataFrame, edits: int | None, min_chars: int) -> DataFrame:
    """lid1, lid2 of the distinct lines that an earlier line is near."""
    # A key and a hash are two numbers, which most keys hold once: grouping them before the shuffle would only cost time.
    key = Window.partitionBy("key")
    shared = _keys(lines, edits, min_chars).select(
        "key", "lid1", F.min("lid1").over(key).alias("least"), F.max("lid1").over(key).alias("most"), F.count("*").over(key).alias("rows"))
    shared = shared.where(F.col("least") < F.col("most"))
    members = materialise(shared.select("key", "lid1", "rows").distinct(), "members")
    leasts = [F.min(F.when(F.pmod("key", F.lit(BINS)) == i, F.col("key"))).alias(f"least{i}") for i in range(BINS)]
    named = materialise(members.groupBy("lid1").agg(*leasts), "ids")
    texts = lines.join(_broadcast(named.select("lid1"), BROADCAST_LINES), "lid1", "left_semi").groupBy("line").agg(F.min(_place()).alias("place"))
    side = F.lit(SIDE * SIDES)
    counts = letter_counts(F.col("line"), F.length("line"))
    # Only lines that one edit is allowed for are compared by their signatures.
    one = F.length("line") <= SEVERAL if edits is None else F.lit(edits == 1)
    ends = F.left("line", side), F.reverse(F.right("line", side))
    texts = texts.select(
        "place", "line", F.xxhash64(F.lit(1), "line").alias("lid1"), F.xxhash64(F.lit(2), "line").alias("lid2"),
        F.length("line").alias("chars"), *[n.alias(f"letters{i}") for i, n in enumerate(counts)],
        *[F.when(one, signature(end)).alias(name) for end, name in zip(ends, ("head", "tail"), strict=True)])
    texts = materialise(texts, "texts")
    sized = members.join(texts.withColumn("order", F.col("place").cast("double")).drop("place", "line", "lid2").join(named, "lid1"), "lid1")
    dealt = _dealt(materialise(sized, "sized"))
    # One earlier line that is near settles a line; only those that no neighbour settles meet all others.
    tries = materialise(_neighbours(dealt, edits), "neighbours")
    near, met = None, None
    for start, end in zip(TRIES, TRIES[1:]):
        open_ = tries if near is None else tries.join(_seekers(texts, near), "lid1", "left_semi")
        tried = open_.select("lid1", F.explode(F.slice("others", start + 1, end - start)).alias("other"))
        tried = materialise(tried.select(F.least("lid1", "other").alias("a"), F.greatest("lid1", "other").alias("b")).distinct(), "tried")
        settled = materialise(_verified(tried, texts, edits), "settled")
        near, met = (settled, tried) if near is None else (near.union(settled), met.union(tried))
    pairs = _pairs(dealt, _seekers(texts, near), edits)
    pairs = materialise(pairs.join(met, ["a", "b"], "left_anti"), "pairs")
    return near.union(_verified(pairs, texts, edits)).distinct()


def _without_copies(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """``lines`` less the copies of lines that occur again, of the most frequent ones where not all may be broadcast.

    What a copy is compared by the first occurrence has too; without copies no key is held by more rows than lines.
    """
    bits = F.length(F.bin("n"))
    least, total = None, 0
    for row in sorted(repeated.groupBy(bits.alias("bits")).agg(F.count("*").alias("lines")).collect(), reverse=True):
        total += row["lines"]
        if total > BROADCAST_LINES:
            break
        least = row["bits"]
    if least is None:
        return lines
    frequent = F.broadcast(repeated.where(bits >= least).select("lid1", "lid2", "owner"))
    return lines.join(frequent, ["lid1", "lid2"], "left").where(F.col("owner").isNull() | (F.col("owner") == _occurrence())).drop("owner")


def _occurrence() -> Column:
    """A document and a line number in one number."""
    return F.xxhash64("k1", "line_no")


def _dropped(docs: DataFrame, id_col: str, text_col: str, edits: int | None, min_chars: int) -> DataFrame:
    """k1, k2 and the line numbers that go, in order, of each document that loses lines."""
    lines = _lines(_documents(docs, id_col, text_col), id_col, text_col)
    lines = lines.where(F.ltrim("line", F.lit(BLANKS)) != "")
    # The owner is the first occurrence, and settles which document's line stays should places be the same.
    repeated = lines.groupBy("lid1", "lid2").agg(F.min_by(_occurrence(), _place()).alias("owner"), F.count("*").alias("n"))
    repeated = materialise(repeated.where(F.col("n") > 1), "repeated")
    near = materialise(_near_lines(_without_copies(lines, repeated), edits, min_chars).withColumn("near", F.lit(True)), "near")
    # Of a line that occurs once and is near no other nothing goes.
    known = repeated.drop("n").join(near, ["lid1", "lid2"], "full")
    known = _broadcast(materialise(known, "known"), BROADCAST_LINES)
    gone = (lines.select("k1", "k2", "line_no", "lid1", "lid2").join(known, ["lid1", "lid2"])
            .where(F.col("near").isNotNull() | (F.col("owner") != _occurrence())))
    return gone.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int | None = None,
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: id, n_lines, n_dropped, dropped (line numbers from 0, in order)."""
    dropped = _dropped(docs, id_col, text_col, edits, min_chars)
    text = F.col(text_col)
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    keyed = _documents(docs, id_col, text_col).select(
        id_col, F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), F.coalesce(feeds + 1, F.lit(0)).alias("n_lines"))
    none = F.array().cast("array<int>")
    return keyed.join(dropped, ["k1", "k2"], "left").select(
        id_col, "n_lines", F.greatest(F.size("dropped"), F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", none).alias("dropped"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int | None = None,
          min_chars: int = MIN_CHARS, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the text less the lines that go.

    ``drop_emptied`` leaves out documents of which no line but blank ones stays
    though some went: all they say stands elsewhere.
    """
    # An array that says of each line, up to the last that goes, whether it does.
    gaps = F.transform("dropped", lambda n, i: n - F.when(i > 0, F.get("dropped", i - 1)).otherwise(-1))
    flags = F.flatten(F.transform(gaps, lambda gap: F.concat(F.array_repeat(F.lit(False), gap - 1), F.array(F.lit(True)))))
    dropped = _dropped(docs, id_col, text_col, edits, min_chars).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), flags.alias("__goes"))
    joined = _documents(docs, id_col, text_col).join(dropped, ["__k1", "__k2"], "left")
    some_go = F.col("__goes").isNotNull()
    stays = lambda line, i: ~F.coalesce(F.get("__goes", i), F.lit(False))
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"), stays), "\n")
    out = joined.withColumn("__text", F.when(some_go, kept).otherwise(F.col(text_col)))
    if drop_emptied:
        out = out.where(~(some_go & (F.ltrim("__text", F.lit(BLANKS + "\n")) == "")))
    return out.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) for c in docs.columns])

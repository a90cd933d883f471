import pytest
from pyspark.sql import functions as F

from hackney.llm import linededup as L
from tests.llm.helpers import documents, levenshtein, mutate, prose, rng


def test_automaton_equals_the_distance(spark):
    r = rng(3)
    pairs = []
    for _ in range(600):
        a = "".join(r.choice("abcé") for _ in range(r.randint(0, 14)))
        pairs.append((a, mutate(a, r.randint(0, 5), r)))
    df = spark.createDataFrame(pairs, "a string, b string")
    chars = lambda c: F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))
    for row in df.select("a", "b", *[L.within(chars("a"), chars("b"), e).alias(f"w{e}") for e in range(4)]).collect():
        for e in range(4):
            assert row[f"w{e}"] == (levenshtein(row.a, row.b) <= e), (row, e)


def _brute(rows, edits, min_chars):
    first = {}
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for i, text in docs:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if line.strip(" \t\r\f\v"):
                place = (2 ** 63 - 1 if i is None else i, n)
                first[line] = min(first.get(line, place), place)
    lines = [x for x in first if len(x) >= min_chars]
    near = set()
    for a in lines:
        for b in lines:
            if first[a] < first[b] and abs(len(a) - len(b)) <= edits and levenshtein(a, b) <= edits:
                near.add(b)
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        gone = [n for n, x in enumerate(lines) if x.strip(" \t\r\f\v")
                and (x in near or first[x] != (2 ** 63 - 1 if i is None else i, n))]
        out.append((i, len(lines), len(gone), gone))
    return out


def _rows():
    r = rng(6)
    base = [prose(r, r.randint(3, 8)) for _ in range(12)]
    rows = []
    for i in range(40):
        lines = [mutate(r.choice(base), r.choice([0, 0, 1, 1, 2, 3]), r) for _ in range(r.randint(1, 5))]
        rows.append((i, "\n".join([*lines, *r.choice([[], [""], ["ab"], [lines[0]], ["  "]])])))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, rows[0][1]), (103, rows[0][1]), (None, rows[1][1] + "\nunseen line of text"),
             (104, "a" * 30000 + "b"), (105, "a" * 30000), (106, "ab\nac"), (107, "\t\f")]
    return rows


@pytest.mark.parametrize("edits", [1, 2])
def test_dropped_lines_equal_brute_force(spark, edits, monkeypatch):
    if edits == 2:
        monkeypatch.setattr(L, "BROADCAST_LINES", 0)  # the way beyond the bound
    rows = [r for r in _rows() if edits == 1 or len(r[1] or "") < 30000]
    got = L.dropped_lines(documents(spark, rows), edits=edits)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "dropped"]
    key = lambda t: (t[0] is None, t[0] or 0, t[3])
    brute = _brute([r for r in rows if len(r[1] or "") < 30000], edits, L.MIN_CHARS)
    brute += [(104, 1, 0, []), (105, 1, 1, [0])] * (edits == 1)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute, key=key)


def test_clean_keeps_the_rest(spark):
    rows = [(1, "first line of some text\nsecond line of some text"), (2, "second line of some text\nthird"),
            (3, "first line of some text"), (4, None), (5, ""), (6, "\nFirst line of some text\n")]
    docs = documents(spark, rows)
    got = L.clean(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {
        1: rows[0][1], 2: "third", 3: "", 4: None, 5: "", 6: "\n"}
    assert {r.doc_id for r in L.clean(docs, drop_emptied=True).collect()} == {1, 2, 4, 5}
    assert L.clean(documents(spark, [])).count() == 0


def test_no_python_on_the_way(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = L.dropped_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def _allowed(a, b):
    return max(1, min(len(a), len(b)) // 64)


def _variants():
    """Lines of each way to find them and at its borders, with variants at and beyond what is allowed."""
    r = rng(8)
    lines = []
    for n in [20, 64, 126, 127, 128, 129, 130, 191, 192, 200, 256, 300, 319, 400, 640, 1000, 1010, 1023, 1024, 1025, 1039, 1040,
              1041, 1100, 2000, 4030, 4095, 4096, 4160, 4161, 4500]:
        for _ in range(2):
            line = prose(r, n)[:n]
            most = max(1, n // 64)
            lines += [line, *[mutate(line, e, r) for e in (most, most, most + 1, r.randint(1, most))]]
            drop = sorted(r.sample(range(n), most))  # as many edits of one kind, spread and in a row
            lines += ["".join(c for i, c in enumerate(line) if i not in drop), line[most:], "é" * most + line]
    lines += ["ab" * 60, "ab" * 61, "a" * 5000, "a" * 5060, "a" * 5150]
    r.shuffle(lines)
    return lines


def test_edits_follow_the_length(spark):
    lines = _variants()
    first = list(dict.fromkeys(lines))
    near = {b for j, b in enumerate(first) for a in first[:j]
            if abs(len(a) - len(b)) <= _allowed(a, b) and len(min(a, b, key=len)) >= L.MIN_CHARS
            and _close(a, b, _allowed(a, b))}
    want = [n for n, x in enumerate(lines) if x in near or lines.index(x) != n]
    assert len(near) > 100
    got = L.dropped_lines(documents(spark, [(1, "\n".join(lines))])).first()
    assert got.dropped == want
    line = prose(rng(9), 100)[:300]
    rows = [(1, line), (2, f"X{line[1:150]}X{line[151:]}")]  # two changed characters in 300
    assert [r.n_dropped for r in L.dropped_lines(documents(spark, rows)).orderBy("doc_id").collect()] == [0, 1]


def _close(a, b, most):
    """Whether a band of the distance table ends within ``most``."""
    far = most + 1
    row = {j: j for j in range(most + 1)}
    for i, x in enumerate(a):
        new = {}
        for j in range(max(0, i + 1 - most), min(len(b), i + 1 + most) + 1):
            new[j] = i + 1 if j == 0 else min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (x != b[j - 1]))
        if min(new.values()) > most:
            return False
        row = new
    return row.get(len(b), far) <= most


def test_one_occurrence_stays_where_ids_tie(spark):
    header = "the same header on line 0"
    rows = [(None, f"{header}\nfirst text without an id"), (None, f"{header}\nanother, quite different"),
            (7, "a shared line of number seven\nwith this"), (7, "a shared line of number seven\nor that below it"),
            (-2 ** 63, "least id there is\nand its text"), (2 ** 63 - 1, "greatest id there is\nwith a text"),
            (2 ** 63 - 1, "greatest id there is\nwith other words")]
    got = L.dropped_lines(documents(spark, rows)).collect()
    gone = {}
    for r in got:
        gone.setdefault(r.doc_id, []).append(r.dropped)
    assert {i: sorted(x) for i, x in gone.items()} == {
        None: [[], [0]], 7: [[], [0]], -2 ** 63: [[]], 2 ** 63 - 1: [[], [0]]}
    kept = "\n".join(r.text for r in L.clean(documents(spark, rows)).collect()).split("\n")
    assert kept.count(header) == kept.count("a shared line of number seven") == 1


def test_rulers_measure_every_distance():
    for marks in L.RULERS:
        found = {abs(a - b) for a in marks for b in marks}
        assert found == set(range(marks[-1] + 1))
    for size, least, longest in ((L.BLOCK, L.SEVERAL, L.WIDE), (L.WIDE_BLOCK, L.WIDE, L.LONG)):
        last = L._last(longest)
        assert size - L.ruler(last)[-1] >= 20  # what is hashed of a block
        for n in range(least, longest):
            half = n // L.PER_EDIT // 2
            assert half <= last and size * (half + 1) <= n // 2
        longer = max(n for n in range(longest, 2 * longest) if n - n // L.PER_EDIT < longest)
        assert longer // L.PER_EDIT // 2 <= last
    edits = range(L.LONG // L.PER_EDIT, 10_000)
    assert all(L.GRAM + L.PERIOD - 1 <= 63 * e // (e + 1) for e in edits)


def test_a_crowded_key_is_dealt_out(spark, monkeypatch):
    """Different lines that share half of them, many to a key: every near pair is met, in parts."""
    monkeypatch.setattr(L, "CHUNK", 7)
    r = rng(10)
    head = prose(r, 40)[:46]
    tails = [prose(r, 20)[:37] for _ in range(60)]
    lines = [head + t for t in tails] + [head + mutate(t, 1, r) for t in tails[:25]] + [head + mutate(t, 3, r) for t in tails[:10]]
    first = list(dict.fromkeys(lines))
    near = {b for j, b in enumerate(first) for a in first[:j] if levenshtein(a, b) <= _allowed(a, b)}
    got = L.dropped_lines(documents(spark, [(i, x) for i, x in enumerate(lines)])).orderBy("doc_id").collect()
    assert len(near) >= 20
    assert [x.n_dropped for x in got] == [int(x in near or lines.index(x) != n) for n, x in enumerate(lines)]


def test_thousands_of_lines_share_a_half(spark):
    r = rng(11)
    head = "https://host.example/path/with/one/long/start/"
    lines = [head + "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(37)) for _ in range(8000)]
    lines[7000] = lines[5][:60] + "é" + lines[5][61:]
    got = L.dropped_lines(documents(spark, [(n, "\n".join(lines[n::100])) for n in range(100)]))
    assert {(r.doc_id, tuple(r.dropped)) for r in got.where("n_dropped > 0").collect()} == {(5, (0,))}


def test_signatures_never_part_lines_one_edit_apart(spark):
    r = rng(11)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abcdé ") for _ in range(r.choice([16, 40, 90, 119, 121, 128, 135, 300])))
        pairs.append((a, mutate(a, 1, r)))
    ends = [F.left(F.col(c), F.lit(L.SIDE * L.SIDES)) for c in "ab"], [F.reverse(F.right(F.col(c), F.lit(L.SIDE * L.SIDES))) for c in "ab"]
    common = [L.alike(L.signature(a), L.signature(b)).cast("long") for a, b in ends]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", (common[0] + common[1]).alias("n"), common[0].alias("head")).collect():
        same = next((i for i, (x, y) in enumerate(zip(row.a, row.b)) if x != y), min(len(row.a), len(row.b)))
        assert row.head >= same
        assert row.n >= min(len(row.a), len(row.b)) - 1


def test_two_places_of_the_cover_are_any_number_apart(spark):
    apart = {(a - b) % L.PERIOD for a in L.COVER for b in L.COVER}
    assert apart == set(range(L.PERIOD))
    # A run of PERIOD + GRAM - 1 equal characters is met whatever stands before it.
    r = rng(12)
    text = lambda n: "".join(r.choice("abcdefgh \r") for _ in range(n))
    run = text(L.PERIOD + L.GRAM - 1)
    rows = [(i, text(L.LONG + i) + run + text(40 + 3 * i)) for i in range(L.PERIOD + 1)]
    lines = spark.createDataFrame(rows, "lid1 long, line string").withColumn("chars", F.length("line"))
    keys = L.place_keys(lines.withColumn("chars", F.greatest("chars", F.lit(2 * L.LONG))))
    held = keys.groupBy("key").agg(F.collect_set("lid1").alias("ids")).where(F.size("ids") > 1).collect()
    met = {(a, b) for row in held for a in row.ids for b in row.ids}
    assert met == {(a, b) for a, _ in rows for b, _ in rows}


def test_variants_of_a_line_do_not_meet_in_all_pairs(spark, monkeypatch):
    """One earlier line that is near settles a line: the pairs grow with the lines, not with their square."""
    rows, listed = L.materialise, {}

    def counted(df, label):
        listed[label] = rows(df, label)
        return listed[label]

    monkeypatch.setattr(L, "materialise", counted)
    monkeypatch.setattr(L, "NEIGHBOURS", 2, raising=False)
    r = rng(13)
    line = prose(r, 200)[:640]
    lines = list(dict.fromkeys(line[:at] + r.choice("xyz") + line[at + 1:] for at in range(320, 620)))
    got = L.dropped_lines(documents(spark, list(enumerate(lines)))).orderBy("doc_id").collect()
    assert [x.n_dropped for x in got] == [0] + [1] * (len(lines) - 1)
    assert sum(listed[label].count() for label in ("neighbours", "pairs") if label in listed) <= len(lines) ** 2 / 4


def test_letter_counts_never_part_lines_within_the_edits(spark):
    r = rng(14)
    pairs = []
    for _ in range(300):
        a = "".join(r.choice("abcdé zq.,ST1\U0001f600") for _ in range(r.choice([16, 90, 300, 900])))
        n = r.randint(1, 12)
        pairs.append((a, mutate(a, n, r), n))
    pairs.append(("a" * 400, "a" * 400 + "b" * 40, 40))
    counts = [L.letter_counts(F.col(c), F.length(c)) for c in "ab"]
    apart = sum(L.counts_apart(x, y) for x, y in zip(*counts, strict=True))
    for row in spark.createDataFrame(pairs, "a string, b string, n int").select("*", apart.alias("apart")).collect():
        assert row.apart + abs(len(row.a) - len(row.b)) <= 2 * row.n, row


def test_a_line_that_one_neighbour_settles_meets_no_other(spark, monkeypatch):
    """The pairs that are compared are one a line where the likeliest neighbour is near, not one a neighbour and key."""
    rows, met = L.materialise, []

    def counted(df, label):
        out = rows(df, label)
        if out.columns == ["a", "b"]:
            met.append(out.count())
        return out

    monkeypatch.setattr(L, "materialise", counted)
    r = rng(15)
    line = prose(r, 200)[:640]
    lines = list(dict.fromkeys(line[:at] + r.choice("xyz") + line[at + 1:] for at in range(320, 520)))
    got = L.dropped_lines(documents(spark, list(enumerate(lines)))).orderBy("doc_id").collect()
    assert [x.n_dropped for x in got] == [0] + [1] * (len(lines) - 1)
    assert 0 < sum(met) <= len(lines)


def test_common_ends_leave_the_distance_as_it_is(spark):
    r = rng(16)
    pairs = [("", ""), ("a" * 200, "a" * 200), ("a" * 200, "a" * 231), ("ab" * 40, "ab" * 41)]
    for _ in range(200):
        a = "".join(r.choice("abé\U0001f600") for _ in range(r.choice([15, 16, 64, 130, 300])))
        pairs.append((a, mutate(a, r.randint(0, 4), r)))
    p = L.stripped(F.col("a"), F.col("b"))
    df = spark.createDataFrame(pairs, "a string, b string").select(F.levenshtein("a", "b").alias("whole"), p.alias("p"), "a")
    got = df.select("whole", F.levenshtein("p.a", "p.b").alias("left"), F.length("p.a").alias("n"), F.length("a").alias("m")).collect()
    assert all(x.whole == x.left for x in got)
    assert sum(x.n for x in got) < sum(x.m for x in got) / 2


def test_the_keys_of_a_text_are_made_once(spark, monkeypatch):
    """The keys of the first occurrence of a line are enough, and one pass over the texts."""
    rows, calls = L.place_keys, []

    def counted(lines, *args):
        out = rows(lines, *args)
        calls.append((lines.count(), out))
        return out

    monkeypatch.setattr(L, "place_keys", counted)
    r = rng(17)
    lines = [prose(r, 60)[:300] for _ in range(20)]
    docs = documents(spark, [(i, "\n".join(lines)) for i in range(30)])
    got = L.dropped_lines(docs).orderBy("doc_id").collect()
    assert [x.n_dropped for x in got] == [0] + [20] * 29
    assert sum(n for n, _ in calls) <= 20
    plan = calls[0][1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("posexplode") <= 1


def test_keys_of_an_even_number_of_edits(spark):
    """E edits need E + 1 blocks, not E + 2; lines that share one that may stand there meet."""
    r = rng(18)
    lines = [(n, prose(r, n)[:n]) for n in (150, 200, 300, 400, 1500)]
    keys = L.place_keys(spark.createDataFrame(lines, "lid1 long, line string").withColumn("chars", F.length("line")))
    marks = lambda last: sum(len(L.ruler(k)) for k in range(last + 1))
    want = {n: marks(n // 64 // 2) + marks((n // 64 - 1) // 2) for n, _ in lines}
    assert {x.lid1: x["count"] for x in keys.groupBy("lid1").count().collect()} == want


def test_pairs_of_a_small_key_are_not_met_again(spark, monkeypatch):
    """Lines that share keys with few lines each are compared among their neighbours alone, and all of them are."""
    rows, listed = L.materialise, {}

    def counted(df, label):
        listed[label] = rows(df, label)
        return listed[label]

    monkeypatch.setattr(L, "materialise", counted)
    r = rng(19)
    lines = []
    for _ in range(30):
        line = prose(r, 100)[:400]
        lines += [line, *[line[:at] + "#" + line[at + 1:] for at in r.sample(range(400), 4)], line[:200] + prose(r, 60)[:200]]
    first = list(dict.fromkeys(lines))
    near = {b for j, b in enumerate(first) for a in first[:j] if abs(len(a) - len(b)) <= 6 and _close(a, b, _allowed(a, b))}
    got = L.dropped_lines(documents(spark, list(enumerate(lines)))).orderBy("doc_id").collect()
    assert [x.n_dropped for x in got] == [int(x in near or lines.index(x) != n) for n, x in enumerate(lines)]
    assert len(near) == 120 and listed["pairs"].count() == 0 and listed["crowded"].count() == 0


def test_starts_are_near_in_lines_within_the_edits(spark):
    r = rng(20)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abé\U0001f600") for _ in range(r.choice([8, 16, 64, 130])))
        b = mutate(a, r.randint(0, 12), r)
        cut = r.randint(0, 5)
        pairs += [(a, b), (a[cut:], b), ("x" * cut + a, b[:len(b) - cut])]
    p = F.struct("a", "b")
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("most", F.levenshtein("a", "b"))
    assert df.where(~L.starts_near(p, 2, F.col("most")) | ~L.starts_near(p, 8, F.col("most"))).count() == 0
    far = spark.createDataFrame([("a" * 400, "b" * 400)], "a string, b string")
    assert far.where(L.starts_near(p, 8, F.lit(20))).count() == 0

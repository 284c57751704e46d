"""SimHash, exact dedup and line dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bedflow.llm import exact_dedup, line_dedup, simhash
from bedflow.llm.common import class_ranks, components, joined_components, stage

from tests.conftest import SF001

DOCS = "doc_id long, text string, lang string, fp string, bucket int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in rows], DOCS)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- shared helpers -----------------------------------------------------------

def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(edges, "src long, dst long"), "t").collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in nodes}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "src long, dst long"), "t").count() == 0


def test_joined_components_equal_those_of_all_links(spark):
    r = random.Random(9)
    old = [(r.randrange(200), r.randrange(200)) for _ in range(90)]
    new = [(r.randrange(260), r.randrange(260)) for _ in range(40)] + [(900, 901)]
    frame = lambda e: spark.createDataFrame(e, "src long, dst long")
    got = joined_components(stage(components(frame(old), "t"), "t"), frame(new), "t")
    want = {r["node"]: r["component"] for r in components(frame(old + new), "t").collect()}
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert got.count() == len(want)


def test_class_ranks_are_gapless_in_order(spark):
    r = random.Random(5)
    rows = [(r.choice([None, 1, 1, 1, 2, 9]), i) for i in range(2000)]
    df = stage(spark.createDataFrame(rows, "k int, v long"), "t")
    by = {}
    for x in class_ranks(df, ["k"], ["v"], "t").collect():
        by.setdefault(x["k"], []).append((x["class_rank"], x["v"]))
    for k, got in by.items():
        assert sorted(got) == list(enumerate(sorted(v for kk, v in rows if kk == k)))


# --- SimHash ------------------------------------------------------------------

def brute_fingerprint(text):
    words = lower(text).encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    comp = list(range(len(ids)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                comp[find(i)] = find(j)
    low = {}
    for i in range(len(ids)):
        low.setdefault(find(i), []).append(ids[i])
    return [min((x for x in low[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_fingerprint_equals_definition_and_spark_hash(spark):
    texts = ["", None, "One", "one TWO", "a b c", "Ä B c d \x0b e f  g", "x " * 4000]
    for t in texts:
        assert simhash.fingerprint(t.encode() if t else None) == brute_fingerprint(t)
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_simhash_whole_table_equals_brute_force(spark):
    from bedflow.llm.queries import op1_simhash
    table = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [r[0] for r in table], [brute_fingerprint(r[1]) for r in table]
    want = {(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(ids, fps))}
    assert {tuple(r)[:3] for r in op1_simhash(spark, SF001).collect()} == want


def test_links_find_every_close_pair(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = set(base) | {0}
    for b in base * 20:
        x = b
        for _ in range(r.randint(1, 4)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    fps |= {base[0] ^ (1 << a) ^ (1 << b) for a in range(32) for b in range(32, 64)}  # a hot bucket
    signed = [(x - 2 ** 64 if x >= 2 ** 63 else x,) for x in fps]
    got = {frozenset((a % 2 ** 64, b % 2 ** 64)) for a, b in simhash.links(
        spark.createDataFrame(signed, "fp long")).collect()}
    arr = np.array(sorted(fps), np.uint64)
    want = set()
    for i, x in enumerate(arr):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ x) <= 3):
            want.add(frozenset((int(x), int(arr[i + 1 + j]))))
    assert got == want


def test_simhash_edge_rows(spark):
    rows = [(5, None), (4, ""), (3, " \t"), (None, ""), (7, "same words here"), (7, "same words here"),
            (9, "SAME words\nhere"), (2, "other")]
    got = sorted(simhash.near_groups(docs(spark, rows)).collect(), key=str)
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["component_id"]) for r in got}
    assert {(5, 3), (4, 3), (3, 3), (None, 3), (7, 7), (9, 7), (2, 2)} == by
    kept = simhash.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "bucket"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "7", "7", "None"]
    assert simhash.near_groups(docs(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0


# --- exact dedup --------------------------------------------------------------

def test_fuse_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 17, 1000, 30_000):
        keys = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        built = exact_dedup.build_filter(keys)
        assert exact_dedup.may_hold(built, keys).all()
        others = rng.integers(2 ** 63, 2 ** 64 - 1, 20_000, dtype=np.uint64)
        assert exact_dedup.may_hold(built, others).mean() < 0.02


def brute_exact(rows):
    by = {}
    for i, t in rows:
        by.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = by[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(lower(t).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("split", ["half", "all new", "all old"])
def test_exact_duplicates_equal_brute_force(spark, split):
    r = random.Random(4)
    texts = ["", None, "A", "a", "Ä", "ä", "long " * 3000, "LONG " * 3000, "x\ny"]
    rows = [(i, r.choice(texts)) for i in range(200)] + [(None, "null id"), (None, "A")]
    cond = {"half": None, "all new": F.lit(False), "all old": F.lit(True)}[split]
    got = exact_dedup.exact_duplicates(docs(spark, rows), cond).collect()
    assert sorted(map(str, [(g[0], g[1], g[2], g[4]) for g in got])) == sorted(map(str, brute_exact(rows)))
    kept = [g for g in got if g["kept"]]
    assert len(kept) == len({lower(t) for _, t in rows}) and all(g["doc_id"] == g["keep_id"] for g in kept)


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(3, "t"), (3, "T"), (1, "t"), (None, "only null"), (None, "only null"), (8, "u")]
    got = exact_dedup.exact_duplicates(docs(spark, rows)).collect()
    assert len(got) == 6 and sum(g["kept"] for g in got) == 3
    kept = exact_dedup.drop_exact_duplicates(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "bucket"]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["3", "8", "None"]
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("more", [[], [(None, "without id")]])
def test_an_id_of_two_texts_loses_only_the_repeated_one(spark, more):
    rows = [(5, "alone here"), (5, "said twice"), (9, "said twice"), (4, "Other"), (4, "other one")] + more
    kept = exact_dedup.drop_exact_duplicates(docs(spark, rows)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(map(str, [rows[0], *rows[2:]]))
    rows = [(5, "alone here"), (5, "said twice"), (3, "Said twice")] + more
    kept = simhash.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "bucket"]
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(map(str, [rows[0], *rows[2:]]))


def test_a_small_snapshot_deals_a_large_batch_over_many_buckets(spark, monkeypatch):
    dealt = []
    screen = exact_dedup.screen
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 50)
    monkeypatch.setattr(exact_dedup, "screen", lambda a, b, n: dealt.append(n) or screen(a, b, n))
    rows = [(i, f"text {i}") for i in range(500)]
    assert exact_dedup.exact_duplicates(docs(spark, rows), F.lit(False)).where("kept").count() == 500
    assert dealt == [10]


def test_different_bytes_under_one_digest_are_told(spark):
    same = spark.createDataFrame([(hashlib.sha256(b"a").digest(), 2)], "digest binary, size long")
    exact_dedup.check_bytes(docs(spark, [(1, "a"), (2, "A")]), same)


# --- line dedup ---------------------------------------------------------------

def jaccard(a, b):
    x, y = line_dedup.shingles(a), line_dedup.shingles(b)
    return len(x & y) / len(x | y)


def variants(r, n=60):
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(400)]
    lines = []
    for _ in range(n):
        base = r.choices(words, k=r.randint(8, 40))
        lines.append(" ".join(base))
        for _ in range(r.randint(0, 4)):
            other = list(base)
            other[r.randrange(len(other))] = r.choice(words)
            lines.append(" ".join(other))
    return lines


@pytest.mark.parametrize("whole", [1024, 8])
def test_line_components_are_those_of_all_similar_pairs(spark, whole):
    r = random.Random(8)
    lines = variants(r)
    hot = " ".join(r.choices(lines[0].split(), k=30))
    lines += [f"{hot} {i:03d}" for i in range(150)]
    df = docs(spark, [(i, x) for i, x in enumerate(lines)])
    rows = line_dedup.distinct_lines(line_dedup.occurrences(df))
    comps = {x["node"]: x["component"] for x in line_dedup.line_components(df, rows, whole=whole).collect()}
    ids = {x["first"]["doc_id"]: comps.get(x["id"], x["id"]) for x in rows.collect()}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in ids:
        for j in ids:
            if j < i and jaccard(lines[i], lines[j]) >= 0.8:
                parent[find(i)] = find(j)
    want, got = {}, {}
    for i in ids:
        want.setdefault(find(i), set()).add(i)
        got.setdefault(ids[i], set()).add(i)
    want, got = set(map(frozenset, want.values())), set(map(frozenset, got.values()))
    # nothing is linked wrongly, and banding's recall leaves at most a few apart
    assert all(any(g <= w for w in want) for g in got)
    assert len(got - want) <= 0.03 * len(want)


def test_bands_recall_at_the_threshold():
    r = random.Random(2)
    found = total = 0
    for _ in range(600):
        a = "".join(r.choices("abcdefgh ", k=r.randint(40, 300)))
        i = r.randrange(len(a))
        b = a[:i] + "".join(r.choices("xyz", k=3)) + a[i:]
        if 0.8 <= jaccard(a, b) < 0.93:
            x, y = line_dedup.bands([a, b])
            total += 1
            found += bool((x == y).any())
    assert total > 100 and found >= 0.97 * total


def test_few_pairs_at_the_threshold_share_no_bucket():
    r, w = random.Random(4), line_dedup.SHINGLE
    lines = []
    for _ in range(12_000):  # 160 of 180 shingles shared, both ways: similarity 0.8
        a = "".join(map(chr, r.choices(range(0x4E00, 0x9000), k=180 + w - 1)))
        lines += [a, a[:160 + w - 1] + "".join(map(chr, r.choices(range(0x4E00, 0x9000), k=20)))]
    found = line_dedup.bands(lines)
    missed = (found[::2] != found[1::2]).all(1).mean()
    assert missed <= 0.0025  # 0.34 % with 10 bands


def test_one_changed_sign_in_a_short_line_links(spark):
    r = random.Random(12)
    lines = []
    for n in range(30, 81):
        for _ in range(3):
            a = "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n - 2)) + "#."
            i = r.randrange(n // 3, n // 2)
            lines += [a, a[:i] + "7" + a[i + 1:]]
    out = {x["doc_id"]: x["_dropped"] for x in line_dedup.dedup_lines(docs(spark, list(enumerate(lines)))).collect()}

    def grams(x):
        return {x[i:i + 5] for i in range(len(x) - 4)}
    want = {i + 1 for i in range(0, len(lines), 2) if len(grams(lines[i]) & grams(lines[i + 1]))
            >= 0.8 * len(grams(lines[i]) | grams(lines[i + 1]))}
    assert {i for i in want if len(lines[i]) < 72} and {i for i, n in out.items() if n} <= want
    assert sum(out[i] for i in want) >= 0.97 * len(want)


def test_shared_buckets_equal_brute_force(spark):
    r = random.Random(6)
    rows = [(i, [r.randrange(400) for _ in range(3)]) for i in range(300)] + [(1000 + i, [7, 7, 8]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, buckets array<long>").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {tuple(x) for x in line_dedup.shared_buckets(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for i, bs in rows:
        for b in set(bs):
            by.setdefault(b, []).append(i)
    want = {(b, i, min(m)) for b, m in by.items() if len(m) > 1 for i in m}
    assert {x for x in got if len(by[x[0]]) > 1} == want


def test_line_dedup_rebuilds_texts(spark):
    rows = [(1, "first line\n\nkeep me"), (2, "FIRST line \nown words of two"), (3, None), (4, ""),
            (None, "null id comes first"), (5, "null id comes first\nlast"), (6, "keep me"), (7, "x\nx\nx")]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert out[1]["text"] == "first line\n\nkeep me" and out[2]["text"] == "own words of two"
    assert out[3]["text"] is None and out[4]["text"] == "" and out[5]["text"] == "last"
    assert out[6]["text"] == "" and out[7]["text"] == "x" and out[None]["text"] == "null id comes first"
    assert out[7]["_dropped"] == 2 and out[2]["lang"] == "en"
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_query_keeps_every_distinct_line_once(spark):
    from bedflow.llm.queries import op10_line_dedup
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    got = op10_line_dedup(spark, SF001).agg(F.count("*"), F.sum("n_lines"), F.sum("n_dropped")).first()
    assert got[0] == table.count()
    lines = [x.strip(" \t\r").lower() for r in table.select("text").collect() for x in (r[0] or "").split("\n")]
    exact = sum(1 for x in lines if x) - len({x for x in lines if x})
    assert got[1] == len(lines) and exact <= got[2] <= 1.2 * exact + 20


def brute_kept(rows):
    """(doc_id, text) after keeping one line of each component of similar lines, over all pairs."""
    first, where = {}, {}
    for i, text in rows:
        for j, line in enumerate(text.split("\n")):
            norm = line_dedup.normal(line)
            if norm:
                where.setdefault(norm, []).append((i, j))
                first.setdefault(norm, (i, j))
    norms = list(where)
    parent = list(range(len(norms)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(norms)):
        for b in range(a):
            if jaccard(norms[a], norms[b]) >= 0.8:
                parent[find(a)] = find(b)
    stays = {}
    for x, norm in enumerate(norms):
        stays[find(x)] = min(stays.get(find(x), first[norm]), first[norm])
    keep = {i: [] for i, _ in rows}
    for i, text in rows:
        for j, line in enumerate(text.split("\n")):
            norm = line_dedup.normal(line)
            if not norm or stays[find(norms.index(norm))] == (i, j):
                keep[i].append(line)
    return {i: "\n".join(x) for i, x in keep.items()}


def test_line_digest_equals_brute_force(spark):
    import zlib
    r = random.Random(3)
    lines = variants(r, 30)
    rows = [(i, "\n".join(r.choices(lines, k=6)) + "\n" + f"own line {i} of this document, and of no other one {i * 37}") for i in range(40)]
    want = brute_kept(rows)
    got = {x["doc_id"]: x for x in line_dedup.digest(docs(spark, rows)).collect()}
    # banding may leave a few similar lines apart; those kept otherwise must be right
    wrong = [i for i, text in want.items() if (got[i]["kept_chars"], got[i]["kept_crc32"]) != (len(text), zlib.crc32(text.encode()))]
    assert len(wrong) <= 1 and {x["n_lines"] for x in got.values()} == {7}


def test_a_document_of_very_many_lines(spark):
    import time
    text = "\n".join("the same line again" if i % 2 else f"{i} x {i * 7919 % 100003} {hashlib.md5(str(i).encode()).hexdigest()}"
                     for i in range(80_000))
    df = docs(spark, [(1, text), (2, text)])
    start = time.time()
    out = {x["doc_id"]: (x["n_lines"], x["n_dropped"]) for x in line_dedup.digest(df).collect()}
    assert out == {1: (80_000, 39_999), 2: (80_000, 80_000)} and time.time() - start < 120


def test_line_dedup_with_columns_of_any_name(spark):
    names = ["id", "t", "_id", "_t", "_w_id", "_text", "_none", "_others", "dropped", "_lines", "_dropped", "_count",
             "_gone", "0", "a b.c`d", "buckets", "key"]
    df = docs(spark, [(1, "one line here\nanother"), (2, "one line here"), (3, None)])
    for n in names:
        df = df.withColumn(n, F.lit(n))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "_lines_", "_dropped_"]
    rows = {x["doc_id"]: x for x in out.collect()}
    assert rows[2]["text"] == "" and rows[2]["_dropped_"] == 1 and rows[3]["text"] is None
    assert all(rows[1][n] == n for n in names)


def test_profiles_never_rule_out_a_similar_pair():
    r = random.Random(9)
    lines = ["a" * 3000, "a" * 10, "ab", "ab", "abab" * 400]
    for _ in range(300):
        a = "".join(r.choices("abc " if r.random() < 0.3 else "abcdefghijklmnop é", k=r.choice([3, 20, 100, 400, 3000])))
        i = r.randrange(len(a))
        lines += [a, a[:i] + "".join(r.choices("xyz", k=r.randint(0, max(1, len(a) // 25)))) + a[i:]]
    _, profile, size = line_dedup.sketches(lines)
    assert size.tolist() == [len(line_dedup.shingles(x)) for x in lines]
    close = 0
    for x in range(0, len(lines) - 1):
        for y in (x + 1, (x * 7) % len(lines)):
            if jaccard(lines[x], lines[y]) >= 0.8:
                close += 1
                assert line_dedup.may_be_similar(profile[x], profile[y], size[x], size[y])
    far = sum(bool(line_dedup.may_be_similar(profile[x], profile[x + 2], size[x], size[x + 2])) for x in range(5, len(lines) - 2))
    assert close > 200 and far < 0.3 * len(lines)


def test_marks_never_rule_out_a_similar_pair_and_packed_shingles_are_exact():
    r = random.Random(4)
    lines = ["a", "ab", "日本語日本語日本", "日本語日本語日本"]
    for _ in range(300):  # more than one block of rows
        a = "".join(r.choices("abc " if r.random() < 0.3 else "abcdefghijklmnop é", k=r.choice([4, 30, 400, 3000])))
        i = r.randrange(len(a))
        lines += [a, a[:i] + "x" * r.randint(0, max(1, len(a) // 40)) + a[i:]]
    for line in lines:
        packed = line_dedup.packed_shingles(line)
        assert packed is None or len(packed) == len(line_dedup.shingles(line))
    marks, exact, close = line_dedup.Marks(lines), line_dedup.Shingled(lines), 0
    assert marks.sizes.tolist() == [len(line_dedup.shingles(x)) for x in lines]
    allowed = list(marks.rows(1, len(lines), 0.8))  # numbers from the second line on
    for x in range(2, len(lines)):
        for y in {x - 1, 1 + (x * 7) % (x - 1)}:
            similar = jaccard(lines[x], lines[y]) >= 0.8
            assert exact.similar(x, y, 0.8) == similar
            if similar:
                close += 1
                assert y - 1 in allowed[x - 1] and marks.may_reach(x, np.array([y]), 0.8).all()
    assert close > 100


def test_few_links_are_those_of_all_pairs_in_each_group():
    r = random.Random(21)
    lines, group = [], []
    for g in range(400):
        signs = r.choice(["abc ", "abcdefghijklmnop é", "日本語文字’ab"])
        a = "".join(r.choices(signs, k=r.choice([5, 12, 40, 300])))
        for _ in range(r.randint(1, line_dedup.FEW)):
            i = r.randrange(len(a))
            lines.append(a[:i] + "".join(r.choices("xyz", k=r.randint(0, max(1, len(a) // 12)))) + a[i:])
            group.append(g)
            a = lines[-1] if r.random() < 0.3 else a
    got = line_dedup.few_links(lines, np.array(group))
    assert all(group[x] == group[y] and jaccard(lines[x], lines[y]) >= 0.8 for x, y in got)

    def parts(links):
        parent = list(range(len(lines)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for x, y in links:
            parent[find(x)] = find(y)
        out = {}
        for x in range(len(lines)):
            out.setdefault(find(x), set()).add(x)
        return set(map(frozenset, out.values())), len(lines) - len(out)
    want = [(x, y) for x in range(len(lines)) for y in range(max(0, x - line_dedup.FEW), x)
            if group[x] == group[y] and jaccard(lines[x], lines[y]) >= 0.8]
    assert parts(got)[0] == parts(want)[0] and len(got) == parts(want)[1] > 300
    # more different signs than a packed shingle can tell apart
    many = ["".join(map(chr, range(0x4E00, 0x4E00 + 5000))), "".join(map(chr, range(0x4E00, 0x4E00 + 5001)))]
    assert line_dedup.few_links(many, np.zeros(2, np.int64)) is None


def test_lines_of_many_signs_are_linked(spark):
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 5000)))
    rows = spark.createDataFrame([(1, 1, many), (1, 2, many + "x"), (1, 3, "ab"), (4, 4, "ab\0\0\0"), (4, 5, "ab")],
                                 "leader long, id long, norm string")
    assert [tuple(sorted(x)) for x in line_dedup.compared_whole(rows).collect()] == [(1, 2)]


def test_buckets_larger_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HELD", 20)
    r = random.Random(7)
    rows = [(i, [r.randrange(60) for _ in range(3)] + [1000 + i]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, buckets array<long>").coalesce(1)
    by = {}
    for i, bs in rows:
        for b in set(bs):
            by.setdefault(b, set()).add(i)
    got = {tuple(x) for x in line_dedup.shared_buckets(df).collect()}
    members, leaders = {}, {}
    for b, i, lead in got:
        members.setdefault(b, set()).add(i)
        leaders.setdefault(b, set()).add(lead)
    shared = {b: m for b, m in by.items() if len(m) > 1}
    assert {b: m for b, m in members.items() if b in shared} == shared
    assert all(len(leaders[b]) == 1 and leaders[b] <= members[b] for b in shared)


def test_borrowed_signatures_and_distinct_lines_equal_plain_ones(spark):
    r = random.Random(5)
    table = np.where(np.array([[r.random() < 0.1 for _ in range(48)] for _ in range(300)]), 2, line_dedup._EMPTY)
    table[:, 7] = 2 * np.arange(300)
    table = table.astype(np.uint32)
    want = table.copy()
    while (want == line_dedup._EMPTY).any():
        right = np.roll(want, -1, axis=1)
        want = np.where((want == line_dedup._EMPTY) & (right != line_dedup._EMPTY), right * np.uint32(0x85EBCA6B), want)
    assert (line_dedup.filled(table) == want).all()
    texts = [(i % 30 if i % 7 else None, "\n".join(f"line {r.randrange(40)}" for _ in range(3))) for i in range(200)]
    lines = [x for _, text in texts for x in text.split("\n")]
    found = line_dedup.occurrences(docs(spark, texts).repartition(4))
    got = {x["key"]: x for x in line_dedup.distinct_lines(found).collect()}
    plain = found.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "t", "line_no")).alias("first")).collect()
    assert len(got) == len(plain) == len(set(lines))
    assert all((got[x["key"]]["n"], got[x["key"]]["first"]) == (x["n"], x["first"]) for x in plain)
    assert sorted(x["n"] for x in plain) == sorted(lines.count(x) for x in set(lines))


@pytest.mark.parametrize("whole", [line_dedup.WHOLE, 8])
def test_what_a_large_group_writes_follows_its_lines_not_their_pairs(spark, monkeypatch, whole):
    r, staged, there = random.Random(9), {}, []
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(4, 9))) for _ in range(3000)]
    lines = []
    for i in range(180):  # unlike each other but for pairs and a family
        base = r.choices(words, k=12)
        lines.append(" ".join(base))
        if i % 9 == 0:
            lines.append(" ".join(base) + " x")
    family = " ".join(r.choices(words, k=30))
    lines += [f"{family} {i:03d}" for i in range(60)]
    plain, dropped = line_dedup.stage, line_dedup.discard

    def stage(df, label, *args, **more):
        out = plain(df, label, *args, **more)
        there.append(out)
        staged.setdefault(label, []).append((out.count(), {c for x in there for c in x.columns}))
        return out

    def discard(*tables):
        gone = {x.staged_at for x in tables}
        there[:] = [x for x in there if x.staged_at not in gone]
        dropped(*tables)
    monkeypatch.setattr(line_dedup, "stage", stage)
    monkeypatch.setattr(line_dedup, "discard", discard)
    # one bucket holds all lines
    monkeypatch.setattr(line_dedup, "shared_buckets", lambda df: df.select(
        F.lit(0).alias("bucket"), "id", F.lit(df.agg(F.min("id")).first()[0]).cast("long").alias("leader")))
    rows = list(enumerate(lines))
    if whole == 8:
        df = docs(spark, rows)
        found = line_dedup.distinct_lines(line_dedup.occurrences(df))
        sizes = line_dedup.line_components(df, found, whole=whole).groupBy("component").count().select("count").collect()
        assert sorted(x[0] for x in sizes) == [2] * 20 + [60]
    else:
        out = {x["doc_id"]: x["_dropped"] for x in line_dedup.dedup_lines(docs(spark, rows)).collect()}
        assert sum(out.values()) == 20 + 59
        # buckets and profiles are gone when texts are moved
        assert not staged["lines-texts"][0][1] & {"buckets", "sketch"}
    assert max(n for found in staged.values() for n, _ in found) <= len(lines)

"""Whitening against numpy, archives against SQL and round trips, spelling
variants against brute force."""

import gzip
import hashlib
import math
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bedflow.llm import spelling, warc, whitening
from bedflow.llm.queries import ORACLE_SQL, QUERIES
from bedflow.session import shared_dir

from tests.conftest import SF001, SF01


# --- whitening ------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, component int, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 9, "clash") for i, v in rows], VECTORS)


def whitened(rows):
    """What whitening should give, by a plain eigendecomposition."""
    x = np.floor(1024 * np.array([v for _, v in rows], dtype=float)) + 100000
    centred = x - x.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(x))
    return values[::-1], centred @ basis[:, ::-1] / np.sqrt(np.where(values[::-1] > 0, values[::-1], 1))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 2**32 - 1), st.sampled_from([0.0, 1e-9, 1.0, 1e6]), st.booleans())
def test_rank_one_update_is_the_eigendecomposition(dims, seed, gap, repeats):
    r = np.random.default_rng(seed)
    d = np.sort(r.integers(0, 4, dims).astype(float) if repeats else r.random(dims) * gap)
    basis, _ = np.linalg.qr(r.normal(size=(dims, dims)))
    z = r.normal(size=dims) * (r.random(dims) < 0.7)
    values, turned = whitening.rank_one(d, basis, z, 2.5)
    want = basis @ np.diag(d) @ basis.T + 2.5 * np.outer(z, z)
    size = max(1.0, np.abs(want).max())
    assert np.all(np.diff(values) >= 0)
    assert np.abs(turned.T @ turned - np.eye(dims)).max() < 1e-12
    assert np.abs(turned @ np.diag(values) @ turned.T - want).max() < 1e-12 * size


def test_roots_of_the_secular_equation_lie_between_the_poles():
    d, w2 = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([0.25, 1e-20, 0.5, 0.25 - 1e-20])
    origin, x = whitening.secular_roots(d, w2 / w2.sum(), 3.0)
    got = d[origin] + x
    assert np.all(got >= d) and np.all(got[:-1] <= d[1:]) and got[-1] <= 8.0
    assert math.isclose(got.sum(), d.sum() + 3.0)


def test_spectra_of_parts_join_to_that_of_the_whole():
    x = np.random.default_rng(5).normal(size=(300, 12)) + 1000
    whole, parts = whitening.Spectrum(12), [whitening.Spectrum(12) for _ in range(3)]
    for row in x:
        whole.add(row[None, :])
    for part, rows in zip(parts, np.split(x, [7, 130])):
        part.add(rows)
    for part in parts[1:]:
        parts[0].join(part.n, part.mean, part.vectors.T, part.values)
    want = np.linalg.eigvalsh(np.cov(x.T) * 299)
    for found in (whole, parts[0]):
        assert found.n == 300 and np.allclose(found.values, want, rtol=1e-9) and np.allclose(found.mean, x.mean(0))


def test_deviations_are_exact():
    r = np.random.default_rng(2)
    for top in (10, 10**6, 2**40):
        x = r.integers(0, top, size=(9, 5))
        sums = [int(s) for s in x.sum(0)]
        want = [sum((9 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, 9, sums) == want


def test_op11_matches_numpy(spark):
    got = QUERIES["op11_whitening"](spark, SF001).toPandas()
    table = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    values, want = whitened(list(zip(table["vec_id"], table["embedding"])))
    assert len(got) == 8 * len(table) and got["identity_error"].max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    for k in range(8):
        assert min(np.abs(wide[:, k] - want[:, k]).max(), np.abs(wide[:, k] + want[:, k]).max()) < 1e-8
    shares = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(shares, (values / values.sum())[:8], rtol=1e-9)


def test_whitening_in_many_partitions_and_rounds(spark):
    r = np.random.default_rng(8)
    rows = [(i, [float(v) for v in r.normal(size=4) * (1, 3, 1, 1)]) for i in range(200)]
    rows += [(7, rows[7][1])] * 70  # repeated rows count each time
    got = whitening.whiten(vectors(spark, rows).repartition(70, F.rand(3)))
    values, want = whitened(rows)
    first = got.where("component = 1").orderBy("vec_id").toPandas()
    size = np.sort(np.abs(want[:, 0]))
    assert got.count() == 4 * 270 and np.allclose(np.sort(np.abs(first["whitened"])), size, atol=1e-9)
    assert np.allclose(first["explained"], values[0] / values.sum())


def test_whitening_of_edge_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.5, 2.0]), (None, [0.0, 2.0]), (3, None), (4, [math.nan, 1.0]),
            (5, [math.inf, 1.0]), (6, [1.0, 2.0, 3.0]), (7, []), (8, [None, 1.0]), (9, [1e300, 1.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    flat = [r for r in got if r["component"] == 2]
    assert all(r["whitened"] is None and r["explained"] == 0 for r in flat)  # no variance there
    x = [1024 + 100000, 1536 + 100000, 100000]
    assert {r["vec_id"]: r["deviation"] for r in flat} == {k: (3 * v - sum(x)) ** 2 for k, v in zip((1, 2, None), x)}
    alone = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in alone] == [(None,) * 3 + (0,)] * 2
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, []), (2, None)])).count() == 0


def test_deviation_beyond_64_bits_is_kept_as_text(spark):
    got = whitening.whiten(vectors(spark, [(1, [2.0**40]), (2, [0.0])])).collect()
    assert {r["deviation"] for r in got} == {None} and {r["deviation_text"] for r in got} == {str(2**100)}


# --- archives -------------------------------------------------------------------

PAGES = "page_id long, url string, html string, row long, record_type string"
LONG = "<p>" + "x" * 200
TRAP = "y" * 100 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "é€𝄞"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 5, "clash") for i, u, h in rows], PAGES)


def test_op12_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF01}/pages.parquet'")
    want = con.execute(ORACLE_SQL["op12_warc"]).df().sort_values("page_id").reset_index(drop=True)
    got = QUERIES["op12_warc"](spark, SF01).toPandas().sort_values("page_id").reset_index(drop=True)
    assert set(got.columns) == set(want.columns)
    for c in want.columns:
        assert got[c].fillna(-1).tolist() == want[c].fillna(-1).tolist()


def test_archived_pages_of_edge_rows(spark):
    rows = [(5, "http://a/", LONG), (3, "http://b/\r\nWARC-Type: revisit", LONG), (9, None, LONG), (None, "u", LONG),
            (4, "", TRAP), (6, "http://c/", TRAP), (6, "http://c/", TRAP), (1, "s", "short"), (2, "s", "short"),
            (7, "e", ""), (8, "n", None), (10, "99", "z" * 99), (11, "99", "z" * 99), (12, "big", "w" * 3_000_000)]
    got = {}
    for r in warc.archived_pages(pages(spark, rows)).collect():
        got.setdefault(r["page_id"], []).append(r)
        text = dict((i, h) for i, _, h in rows)[r["page_id"]] or ""
        assert r["payload_bytes"] == len(text.encode())
        assert r["payload_digest"] == hashlib.sha256(text.encode()).hexdigest()
    kinds = {k: sorted((r["record_type"], r["refers_to"]) for r in v) for k, v in got.items()}
    whole = [("response", None)]
    assert kinds == {3: whole, 5: [("revisit", 3)], 9: [("revisit", 3)], None: [("revisit", 3)], 4: whole,
                     6: [("revisit", 4)] * 2, **{k: whole for k in (1, 2, 7, 8, 10, 11, 12)}}
    assert warc.archived_pages(pages(spark, [])).count() == 0
    twins = warc.archived_pages(pages(spark, [(1, "a", LONG), (1, "a", LONG)])).collect()
    assert sorted((r["record_type"], r["refers_to"]) for r in twins) == [("response", None), ("revisit", 1)]


def written(spark, rows, name, **kw):
    path = f"{shared_dir(spark)}/{name}-{random.randrange(10**9)}"
    return warc.deduplicated(warc.page_records(pages(spark, rows)), path, **kw)


def test_archives_hold_each_payload_once_and_are_bounded(spark):
    rows = [(i, f"http://h/{i}", f"{i % 40} " + "t" * 500) for i in range(400)]
    path = written(spark, rows, "bounded", archive_bytes=20_000)
    files = list(Path(path).glob("part-*.gz"))
    raw = [gzip.decompress(f.read_bytes()) for f in files]
    assert len(files) >= 8 and sum(r.count(b"t" * 500) for r in raw) == 40
    assert sum(r.count(b"WARC-Type: revisit") for r in raw) == 360
    ids = [x for r in raw for x in r.split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
    assert len(set(ids)) == 400
    back = {r["page_id"]: r["payload"] for r in warc.read_archives(spark, path).where("record_type = 'response'").collect()}
    assert back == {i: h for i, _, h in rows[:40]}


def test_parser_reads_members_plain_bytes_and_stops_at_a_cut():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\na\r\nb\r\n\r\n"
    for data in (record * 2, gzip.compress(record * 2), gzip.compress(record) + gzip.compress(record)):
        assert [(h["warc-type"], b) for h, b in warc.parsed(data)] == [("response", b"a\r\nb")] * 2
    with pytest.raises(ValueError):
        list(warc.parsed(record[:-8]))
    with pytest.raises(ValueError):
        list(warc.parsed(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_rewritten_archives_resolve_the_revisits_of_others(spark):
    """The first record by page_id becomes the response, though another held the payload."""
    digest = hashlib.sha256(LONG.encode()).hexdigest()

    def record(page, kind, rid, body, refers=None, of=None):
        size = len(body.encode()) if kind == "response" else 203
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {size}\r\n\r\n{body if kind == 'response' else ''}"
        extra = f"WARC-Refers-To: {refers}\r\n" if refers else ""
        return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\nWARC-X-Page-Id: {page}\r\n{extra}"
                f"WARC-Date: 1999-01-01T00:00:00Z\r\nWARC-Target-URI: http://p/{page}\r\n"
                f"WARC-Payload-Digest: sha256:{of or hashlib.sha256(body.encode()).hexdigest()}\r\n"
                f"Content-Length: {len(block.encode())}\r\n\r\n{block}\r\n\r\n")
    text = (record(9, "response", "<r9>", LONG) + record(2, "revisit", "<r2>", "", "<r9>", digest)
            + record(3, "revisit", "<r3>", "", None, digest) + record(4, "response", "<r4>", "tiny")
            + record(6, "revisit", "<r6>", "", "<r4>", hashlib.sha256(b"tiny").hexdigest())
            + record(5, "revisit", "<r5>", "", "<gone>", "ab" * 32)
            + "WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    base = Path(shared_dir(spark)) / f"foreign-{random.randrange(10**9)}"
    base.mkdir()
    (base / "a.warc.gz").write_bytes(gzip.compress(text.encode()))
    target = warc.rewritten(spark, str(base), f"{base}-out")
    got = {r["page_id"]: (r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"])
           for r in warc.resolved(warc.read_archives(spark, target)).collect()}
    tiny = hashlib.sha256(b"tiny").hexdigest()
    assert got == {2: ("response", 203, digest, None), 3: ("revisit", 203, digest, 2), 9: ("revisit", 203, digest, 2),
                   4: ("response", 4, tiny, None), 6: ("response", 4, tiny, None),
                   5: ("revisit", 203, "ab" * 32, None)}
    kept = {r["page_id"]: r for r in warc.read_archives(spark, target).collect()}
    assert kept[2]["payload"] == LONG and kept[6]["payload"] == "tiny" and kept[5]["refers_to_id"] == "<gone>"
    assert kept[9]["uri"] == "http://p/9" and kept[9]["date"] == "1999-01-01T00:00:00Z"


@pytest.mark.parametrize("limits", [(10, 50_000), (10, 0)])
def test_hot_payloads_are_joined_apart(spark, monkeypatch, limits):
    monkeypatch.setattr(warc, "HOT_ROWS", limits[0])
    monkeypatch.setattr(warc, "BROADCAST_KEYS", limits[1])
    rows = [(i, "u", LONG if i % 3 else f"{i % 5}" * 150) for i in range(120)]
    got = warc.archived_pages(pages(spark, rows)).collect()
    first = {}
    for i, _, h in rows:
        first.setdefault(h, i)
    assert {r["page_id"]: r["refers_to"] for r in got} == {i: first[h] if first[h] != i else None for i, _, h in rows}


# --- spelling -------------------------------------------------------------------

DOCS = "doc_id long, text string, word string, n long, key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "k") for i, t in rows], DOCS)


def brute(rows):
    import re
    from collections import Counter
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    found = {w: sorted((o for o in words if o != w and near(w, o)), key=lambda o: (-words[o], o)) for w in words}
    form = {w: f[0] for w, f in found.items() if f and words[f[0]] >= 10 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(found[w]), words[form[w]] if w in form else None)
    return out


def result(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def spelled(seed, n=60, letters="abcdeéÿxz"):
    """Words of few letters, so that many are near each other and share reduced forms; some a hundredfold."""
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(7, 10))) for _ in range(n)]
    for w in list(base):
        i = r.randrange(len(w))
        base += [w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1:]]
    words = [w for w in base for _ in range(r.choice([1, 2, 3, 25, 300]))]
    r.shuffle(words)
    return [(i, " ".join(words[at:at + 50])) for i, at in enumerate(range(0, len(words), 50))]


@pytest.mark.parametrize("symbols,hot", [(8, 256), (2, 256), (2, 1), (1, 3), (8, 0)])
def test_variants_match_brute_force(spark, symbols, hot):
    """Also with hardly any symbols, and with every form treated as hot."""
    rows = spelled(symbols * 10 + hot)
    want = brute(rows)
    assert result(spelling.variants(docs(spark, rows), symbols=symbols, hot_form=hot)) == want
    assert any(v[0] for v in want.values()) and any(v[3] > 3 for v in want.values())


def test_op13_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    assert result(spelling.variants(docs(spark, rows))) == brute(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(2, 4))
def test_neighbourhood_is_every_form_one_edit_away(form, symbols):
    form = [s % symbols for s in form]
    near = set(spelling.neighbourhood(np.array([form], dtype=np.uint64), symbols)[0].tolist())

    def key(f):
        return int(spelling.keys(np.array([f], dtype=np.uint64))[0]) if f else 0
    want = {key(form)}
    for i in range(len(form) + 1):
        want |= {key(form[:i] + [s] + form[i:]) for s in range(symbols)}
        if i < len(form):
            want |= {key(form[:i] + form[i + 1:])} | {key(form[:i] + [s] + form[i + 1:]) for s in range(symbols)}
    assert near == want


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("a", "w4")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w9" for i in range(9)}, "a": "w9"}


def test_spelling_of_edge_rows(spark):
    long = "ab" * 30_000
    rows = [(1, None), (2, ""), (3, "short words only 1234567"), (None, "Übermäßig übermäßig ÜBERMÄßIG ÷×÷×÷×÷ ÷×÷×÷×÷"),
            (4, f"{long} {long} {long}b {long}b"), (5, "repeated\nrepeated"), (5, "repeated\nrepeated"),
            (6, "Repeated-repeateD repeates'repeates"), (7, "x" * 100_000), (7, "x" * 100_000)]
    assert result(spelling.variants(docs(spark, rows))) == brute(rows)
    assert result(spelling.variants(docs(spark, [(1, None)]))) == {}
    assert result(spelling.variants(docs(spark, []))) == {}

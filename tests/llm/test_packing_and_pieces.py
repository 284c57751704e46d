"""Packing and SentencePiece codes against the libraries and round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bedflow.llm import packing, pieces

from tests.conftest import SF001
from tests.llm.test_dedup import docs


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
@settings(max_examples=150, deadline=None)
def test_runs_equal_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    space, ranks = {}, {}
    for length, rank, n, first, offset in packing.plan_runs(counts, capacity):
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + n
        for s in range(first, first + n):
            assert space.get(s, 0) == offset
            space[s] = offset + length
            assert space[s] <= capacity
    assert ranks == counts and len(space) == best_fit_decreasing(lengths, capacity)


def runs_of(lengths, gaps):
    rows = [(packing.PIECE, n, 0, lengths.count(n), None, None, None) for n in set(lengths)]
    return rows + [(packing.GAP, g, i, 1, None, None, None) for i, g in enumerate(gaps)]


@given(st.lists(st.integers(1, 40), max_size=60), st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=200, deadline=None)
def test_sweep_gives_each_piece_the_smallest_gap_left(lengths, gaps):
    """Against a list of gaps, each used once, where the longest pieces choose first."""
    free, want = sorted(gaps), {}
    for n in sorted(set(lengths), reverse=True):
        left = lengths.count(n)
        while left and free and free[-1] >= n:
            gap = next(g for g in free if g >= n)
            free.remove(gap)
            take = min(left, gap // n)
            want[gap, n, take] = want.get((gap, n, take), 0) + 1
            left -= take
    got, unplaced = {}, 0
    for kind, size, first, n, seq, per, offset in packing.sweep(runs_of(lengths, gaps), 64):
        if kind == packing.PLACED:
            for at in range(0, n, per):
                key = 64 - offset, size, min(per, n - at)
                got[key] = got.get(key, 0) + 1
        elif kind == packing.PIECE:
            unplaced += n
    assert got == want
    assert unplaced == len(lengths) - sum(k[2] * v for k, v in want.items())


@given(st.lists(st.integers(1, 64), max_size=60), st.lists(st.integers(1, 64), max_size=60), st.sampled_from([2, 4, 16]))
@settings(max_examples=100, deadline=None)
def test_sweeping_ranges_first_gives_the_same_matches(lengths, gaps, ranges):
    rows, kept, done = runs_of(lengths, gaps), [], []
    for k in range(ranges):
        for row in packing.sweep([r for r in rows if (r[1] - 1) * ranges // 64 == k], 64):
            (kept if row[0] in (packing.GAP, packing.PIECE) else done).append(row)
    for row in packing.sweep(kept, 64):
        done.append(row)

    def total(found):
        out = {}
        for kind, size, _, n, seq, per, offset in found:
            if kind == packing.PLACED:
                out[size, offset] = out.get((size, offset), 0) + n
            elif kind != packing.SHRUNK:
                out[kind, size] = out.get((kind, size), 0) + n
        return out
    assert total(done) == total(packing.sweep(rows, 64))


def sequences(rows):
    return max((r["first_seq"] + -(-r["n"] // r["per"]) for r in rows), default=0)


@pytest.mark.parametrize("name", ["mixed", "short", "one_length", "one_piece"])
def test_rounds_need_hardly_more_sequences_than_best_fit_decreasing(spark, name):
    r = random.Random(5)
    lengths = {"mixed": [r.randint(1, 2048) for _ in range(30_000)], "short": [r.randint(1, 300) for _ in range(30_000)],
               "one_length": [700] * 30_001, "one_piece": [3]}[name]
    counts = {n: lengths.count(n) for n in set(lengths)}
    before = spark.createDataFrame(list(counts.items()), "length long, n long")
    rows = packing.place_runs(before).collect()
    ranks, used = {}, {}
    for row in sorted(rows, key=lambda x: (x["length"], x["first_rank"])):
        assert row["first_rank"] == ranks.get(row["length"], 0)  # every rank once
        ranks[row["length"]] = row["first_rank"] + row["n"]
        for at in range(0, row["n"], row["per"]):
            here = row["first_seq"] + at // row["per"]
            used.setdefault(here, []).append((row["offset"], min(row["per"], row["n"] - at) * row["length"]))
    assert ranks == counts and sorted(used) == list(range(sequences(rows)))
    for parts in used.values():
        end = 0
        for offset, tokens in sorted(parts):
            assert offset == end
            end += tokens
        assert end <= 2048
    best = max(first + n for _, _, n, first, _ in packing.plan_runs(counts))
    assert sequences(rows) <= best * 1.002 + 1


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    lib, own = Tokenizer.from_file(path), packing.Encoder.of(path)
    r = random.Random(1)
    signs = "ab Zé漢😀\n\t   'sll!?12٣<|endoftext|>."
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "x" * 3000, " " * 500 + "a"] + [
        "".join(r.choices(signs, k=r.randint(0, 60))) for _ in range(500)]
    for t in texts:
        assert own(t) == lib.encode(t, add_special_tokens=False).ids


def test_pack_whole_table(spark):
    from tokenizers import Tokenizer

    from bedflow.llm.queries import op2_packing
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    lib = Tokenizer.from_file(packing.default_tokenizer())
    rows = op2_packing(spark, SF001).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(table)
    total = 0
    for doc, parts in by.items():
        ids = np.array(lib.encode(table[doc] or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        parts.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert all(p["length"] == 2048 for p in parts[1:])
        at = 0
        for p in parts:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    used = check_packed(rows, 2048)
    assert used == best_fit_decreasing([r["length"] for r in rows], 2048)
    assert used <= -(-total // 2048) * 1.05 + 1


def test_pack_edge_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "word " * 9000), (3, "a")]
    got = packing.pack_documents(docs(spark, rows), capacity=512).collect()
    check_packed(got, 512)
    assert sorted(str(r["doc_id"]) for r in got if r["length"] == 1 and r["doc_id"] != 2) == ["1", "1", "None"]
    assert packing.pack_documents(docs(spark, [])).count() == 0


# --- SentencePiece ------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=pieces.default_model())


def test_codec_equals_the_library(library, spark):
    codec = pieces.Codec.of(pieces.default_model())
    texts = [r[0] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    r = random.Random(3)
    signs = "the and of ing  \n\t,.;'()²½xm0189éß漢字😀▁"
    texts += ["", " ", "▁", "   lead", "trail   ", "m².", "a" * 700] + [
        "".join(r.choices(signs, k=r.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        ids = codec.encode(t)
        assert ids == library.encode(t), t
        assert codec.decode(ids) == library.decode(ids) == t.replace("▁", " ")


def test_search_commits_within_its_window(library):
    codec = pieces.Codec.of(pieces.default_model())
    r = random.Random(4)
    text = "".join(r.choices("theandofings", k=20_000))
    parts = list(codec.search("▁" + text))
    assert [i for p in parts for i in p] == library.encode(text)
    assert len(parts) > 100 and codec.most_kept < 40 * codec.max_piece


def test_score_search_is_the_best_sum():
    codec = pieces.Codec(pieces.default_model())
    codec.piece = {"a": (0, -1.0), "b": (1, -2.5), "ab": (2, -3.0), "ba": (3, -2.0), "aba": (4, -4.5), "bb": (5, -3.0)}
    codec.by_merges, codec.max_piece, codec.unknown = False, 3, -20.0
    score = {p: s for p, (_, s) in codec.piece.items()}
    name = {i: p for p, (i, _) in codec.piece.items()}
    r = random.Random(5)
    for _ in range(200):
        text = "".join(r.choices("ab", k=r.randint(1, 40)))
        best = [0.0] + [-1e9] * len(text)
        for e in range(1, len(text) + 1):
            best[e] = max(best[s] + score[text[s:e]] for s in range(max(0, e - 3), e) if text[s:e] in score)
        got = [name[i] for part in codec.search(text) for i in part]
        assert "".join(got) == text and abs(sum(score[p] for p in got) - best[-1]) < 1e-9


def test_codes_round_trip_as_tables(spark):
    rows = [(1, "Some text, twice.\nWörter 漢字"), (1, "Some text"), (None, None), (2, ""), (3, "z" * 30_000)]
    coded = pieces.encode(docs(spark, rows))
    back = sorted(map(str, pieces.decode(coded).collect()))
    assert back == sorted(map(str, (type(x)(doc_id=i, text=t or "") for (i, t), x in zip(
        rows, pieces.decode(coded).collect()))))
    got = pieces.digest(docs(spark, rows)).collect()
    assert len(got) == 5 and [r["round_trip"] for r in got] == [True] * 5
    assert pieces.digest(docs(spark, [])).count() == 0


def test_piece_query_equals_the_library(spark, library):
    from bedflow.llm.queries import op5_sentencepiece
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op5_sentencepiece(spark, SF001).collect()
    assert {r["doc_id"] for r in rows} == set(table)
    for r in rows:
        ids = np.array(library.encode(table[r["doc_id"]] or ""), "<u4")
        assert (r["n_ids"], r["ids_crc32"], r["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True)

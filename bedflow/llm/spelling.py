"""Spelling variants: words one edit apart, found in a reduced alphabet.

Words are the runs of Latin letters in whole texts, counted.  Letters are hashed
to ``SYMBOLS`` symbols.  A word's reduced form is shorter on information, not on
length, so words one edit apart have reduced forms that are equal or one edit
apart.  From every reduced form its full one-edit neighbourhood (deletions,
replacements, insertions) is generated, joined with the reduced vocabulary, and the
words of both forms are compared by their letters.

Forms are keys of 64 bits (a polynomial in the symbols), so the neighbourhood
is computed by arithmetic on columns of equal length.  Two forms that happen to
share a key only add candidates; every pair is verified on the words.
Neighbourhoods hold each other, so of two forms the smaller key alone carries the link.
Before the shuffle, variants meet a bitmap of the keys in the vocabulary: 2^26 bits (8 MB)
at every size; it lets all links pass, and the fewer others the emptier it is.

A reduced form that more than ``HOT_FORM`` words share would compare them all.
Its words, and those of the forms one edit away, are joined by their own letters
with one position left out instead: as many rows as letters, and only true
neighbours meet.  Nothing is left out or capped on either way.

Null texts have no words; a null doc_id is an empty text in the hash that
picks the altered runs.  Rows that repeat a doc_id, or whole rows, count each
time.  Other columns are ignored, whatever their names.  Words without near words
have no form and are their own root.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import SLICE, stage

MIN_LENGTH, MIN_COUNT = 7, 2
#: A form has at least this many times a word's occurrences.
RATIO = 10
#: One run in this many, by its hash, loses a sign.
ALTERED = 31
#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Words that may share a reduced form before they are joined by their letters.
HOT_FORM = 256
#: Bits of the bitmap of reduced keys.
BITMAP_BITS = 26
#: Different words that a task counts before it hands them on.
COUNTED = 200_000
#: Variants that a task holds at once.
VARIANTS = 2_000_000

# The letters of a word.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))  # A-Z in UTF-8 bytes
LETTERS = "A-Za-zÀ-ÿ"
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
MASK = 2**64 - 1


# --- words ---------------------------------------------------------------------

def altered(doc_id: str, run: str, seen: int) -> str:
    """The run, without one sign if its hash says so.  ``seen`` is the crc32 of '<doc_id>:'."""
    h = zlib.crc32(run.encode("utf-8"), seen)
    if h % ALTERED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) of at least
    ``min_length`` signs and ``min_count`` occurrences.  A task counts before
    the shuffle, ``COUNTED`` different words at a time."""
    # shorter runs cannot become words; a match is always a maximal run
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return got
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for doc_id, text in zip(part.column("doc_id"), part.column("text")):
                    if not text.is_valid:
                        continue
                    text = text.as_buffer().to_pybytes().translate(LOWER).decode("utf-8")
                    name = doc_id.as_py() or ""
                    seen = zlib.crc32(f"{name}:".encode())
                    for found, times in Counter(runs.findall(text)).items():
                        word = altered(name, found, seen)
                        if len(word) >= min_length:
                            counts[word] += times
                    if len(counts) >= COUNTED:
                        yield out()
        yield out()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


# --- reduced forms -------------------------------------------------------------

def symbol(letter: int, symbols: int) -> int:
    return zlib.crc32(chr(letter).encode("utf-8")) % symbols


def reduced(words: list[str], symbols: int) -> list[np.ndarray]:
    """The symbols of each word's letters."""
    table = np.array([symbol(c, symbols) for c in range(0x100)], dtype=np.uint64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return np.split(table[codes], ends[:-1]) if words else []


def powers(n: int) -> np.ndarray:
    """MULTIPLIER^0 .. MULTIPLIER^n modulo 2^64."""
    out = np.empty(n + 1, dtype=np.uint64)
    at = 1
    for i in range(n + 1):
        out[i] = at
        at = at * MULTIPLIER & MASK
    return out


def keys(forms: np.ndarray) -> np.ndarray:
    """The key of each row of symbols: sum (symbol + 1) * M^position."""
    return ((forms + np.uint64(1)) * powers(forms.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood(forms: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of all forms one edit from each row of ``forms`` (rows of equal
    length), one row of keys each.  A deletion inside a run of equal symbols,
    or an insertion of a symbol behind itself, repeats another: such cells
    hold the form's own key."""
    m, n = forms.shape
    power = powers(n)
    own = (forms + np.uint64(1)) * power[:-1]
    start = np.zeros((m, n + 1), dtype=np.uint64)
    start[:, 1:] = np.cumsum(own, axis=1, dtype=np.uint64)
    whole = start[:, -1:]
    rest = whole - start  # what begins at each position
    inverse = np.uint64(pow(MULTIPLIER, -1, 2**64))
    again = np.zeros((m, n), dtype=bool)
    again[:, 1:] = forms[:, 1:] == forms[:, :-1]
    out = [np.where(again, whole, start[:, :-1] + rest[:, 1:] * inverse)]
    for s in range(symbols):
        other = np.uint64(s + 1)
        out.append(start[:, :-1] + other * power[:-1] + rest[:, 1:])  # the form itself where s is there already
        put = start + other * power + rest * np.uint64(MULTIPLIER)
        behind = np.zeros((m, n + 1), dtype=bool)
        behind[:, 1:] = forms == np.uint64(s)
        out.append(np.where(behind, whole, put))
    return np.concatenate(out, axis=1)


def by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, matrix of symbols) of the words of each length."""
    forms = reduced(words, symbols)
    lengths = np.array([len(f) for f in forms])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, np.stack([forms[i] for i in at])


def with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, key, form): the key of the reduced word, and its symbols as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            found, forms = np.zeros(len(texts), dtype=np.uint64), [""] * len(texts)
            for at, matrix in by_length(texts, symbols):
                found[at] = keys(matrix)
                # one sign a symbol, from 'A' on
                rows = (matrix.astype(np.uint8) + 65).tobytes().decode("latin-1")
                for i, j in enumerate(at):
                    forms[j] = rows[i * matrix.shape[1]:(i + 1) * matrix.shape[1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(found.view(np.int64)), pa.array(forms, pa.string())],
                names=["word", "n", "key", "form"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, key long, form string")


def bitmap(vocabulary: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """One bit for each possible value of a key's lowest ``bits`` bits: set if a
    key of the vocabulary has it.  2^(bits - 3) bytes at every size."""
    low = F.col("key").bitwiseAND(F.lit(2**bits - 1)) + 1
    parts = (vocabulary.select(F.bitmap_bucket_number(low).alias("at"), F.bitmap_bit_position(low).alias("bit"))
             .groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = bytearray(2 ** (bits - 3))
    for part in parts:
        first = (part["at"] - 1) * 4096
        out[first:first + 4096] = part["bits"]
    return bytes(out)


def near_forms(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(mine, other): keys of the reduced vocabulary one edit apart, each link
    once, mine < other.  ``vocabulary`` is staged: key, form."""
    present = bitmap(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(present, dtype=np.uint8)
        low = np.uint64(2**BITMAP_BITS - 1)
        for batch in batches:
            texts = batch.column("form").to_pylist()
            grouped: dict[int, list[str]] = {}
            for text in texts:
                grouped.setdefault(len(text), []).append(text)
            for n, same in grouped.items():
                step = max(1, VARIANTS // ((2 * n + 1) * symbols + n))
                for at in range(0, len(same), step):
                    some = same[at:at + step]
                    forms = (np.frombuffer("".join(some).encode("latin-1"), dtype=np.uint8).reshape(-1, n) - 65
                             ).astype(np.uint64)
                    near = neighbourhood(forms, symbols)
                    mine = np.broadcast_to(keys(forms).view(np.int64)[:, None], near.shape)
                    cell = (near & low).astype(np.int64)
                    keep = (known[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
                    other = near.view(np.int64)
                    keep &= mine < other
                    yield pa.RecordBatch.from_arrays([pa.array(mine[keep]), pa.array(other[keep])],
                                                     names=["mine", "other"])
    variants = vocabulary.select("form").mapInArrow(run, "mine long, other long").distinct()
    return variants.join(vocabulary.select(F.col("key").alias("other")).distinct(), "other", "left_semi")


# --- near words ----------------------------------------------------------------

def one_edit(a: str, b: str):
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def _by_letters(words: DataFrame) -> DataFrame:
    """Pairs (word, n, other, other_n) of ``words`` (word, n, hot) one edit
    apart, at least one of them hot: joined by what is left without one position."""
    cut = F.transform(F.sequence(F.lit(1), F.length("word")),
                      lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1),
                                         F.substring(F.col("word"), i + 1, F.length("word"))))
    left = words.select(*[F.col(c).alias(f"l_{c}") for c in ("word", "n", "hot")],
                        F.posexplode(cut).alias("at", "rest"))
    right = left.select("at", "rest", *[F.col(f"l_{c}").alias(f"r_{c}") for c in ("word", "n", "hot")])
    replaced = left.join(right, ["at", "rest"]).where("l_word < r_word")
    longer = left.drop("at").distinct().join(
        words.select(F.col("word").alias("rest"), *[F.col(c).alias(f"r_{c}") for c in ("word", "n", "hot")]), "rest")
    pairs = [x.where("l_hot or r_hot").select("l_word", "l_n", "r_word", "r_n") for x in (replaced, longer)]
    return pairs[0].unionByName(pairs[1])


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, hot_form: int = HOT_FORM) -> DataFrame:
    """(l_word, l_n, r_word, r_n): every two words one edit apart, once."""
    words = stage(with_keys(words, symbols), "spelling-words")
    vocabulary = stage(words.groupBy("key", "form").agg(F.count(F.lit(1)).alias("members")), "spelling-forms")
    links = stage(near_forms(vocabulary, symbols), "spelling-links")
    sizes = vocabulary.groupBy("key").agg(F.sum("members").alias("members"))
    hot = stage(sizes.where(F.col("members") > hot_form).select("key"), "spelling-hot")
    own = sizes.where((F.col("members") > 1) & (F.col("members") <= hot_form)).select(
        F.col("key").alias("mine"), F.col("key").alias("other"))
    plain, hot_pairs = links, None
    if hot.limit(1).count():
        ends = [hot.select(F.col("key").alias(c)) for c in ("mine", "other")]
        plain = links.join(ends[0], "mine", "left_anti").join(ends[1], "other", "left_anti")
        touched = (links.join(ends[0], "mine", "left_semi").select(F.col("other").alias("key"))
                   .unionByName(links.join(ends[1], "other", "left_semi").select(F.col("mine").alias("key")))
                   .unionByName(hot).distinct())
        near_hot = words.join(touched, "key", "left_semi").join(hot.withColumn("hot", F.lit(True)), "key", "left")
        hot_pairs = _by_letters(near_hot.select("word", "n", F.coalesce("hot", F.lit(False)).alias("hot")))

    def side(name: str, key: str) -> DataFrame:
        return words.select(F.col("key").alias(key), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))

    pairs = (plain.unionByName(own).join(side("l", "mine"), "mine").join(side("r", "other"), "other")
             .where((F.col("mine") != F.col("other")) | (F.col("l_word") < F.col("r_word")))
             .where(one_edit("l_word", "r_word")).select("l_word", "l_n", "r_word", "r_n"))
    return pairs if hot_pairs is None else pairs.unionByName(hot_pairs)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): forms are followed to the last,
    in steps that double (a form has ten times a word's occurrences, so few)."""
    hops = stage(forms.select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if not hops.join(ahead, "root", "left_semi").limit(1).count():
            return hops
        hops = stage(hops.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")),
                     "spelling-hops")


def variants(docs: DataFrame, symbols: int = SYMBOLS, hot_form: int = HOT_FORM, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``: ``form``
    is its near word of most occurrences (ties: the smallest in code-point
    order), if those are ``ratio`` times its own; ``root`` is where forms end."""
    words = stage(word_counts(docs), "spelling-counts")
    pairs = near_pairs(words, symbols, hot_form)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("l_word").alias("word"), F.col("r_n").alias("m"), F.col("r_word").alias("near")),
        F.struct(F.col("r_word").alias("word"), F.col("l_n").alias("m"), F.col("l_word").alias("near")))).alias("x"))
    # smallest by (-m, near): strings compare by their UTF-8 bytes, which is code-point order
    best = both.select("x.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), "near")).alias("best"))
    known = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best")).alias("best")), "spelling-known")
    ends = roots(known.where("best is not null").select("word", F.col("best.near").alias("form")))
    return known.join(ends, "word", "left").select(
        "word", F.col("best.near").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        (-F.col("best.minus")).alias("form_n"))

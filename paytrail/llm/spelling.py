"""Spelling variants grouped by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols, so a vocabulary of words becomes a smaller one of reduced
words. One edit between two words is at most one edit between their reduced forms. So each reduced
word generates its full one-edit neighbourhood (itself, every deletion, replacement and
insertion over the symbols), the neighbourhoods are joined with the reduced vocabulary, and
the words behind two reduced words that meet are compared letter by letter.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import shipped, store

#: Symbols of the reduced alphabet. More make larger neighbourhoods, fewer make fuller classes.
SYMBOLS = 8
#: One word in so many, told by a hash of document and word, loses a letter before it is counted.
TYPO_EVERY = 97
#: Shortest word, in code points, and least number of occurrences of a word of the vocabulary.
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: How many times as frequent as a word its form must be.
DOMINANCE = 2
#: Distinct words a task counts before it hands them on, and neighbours it makes at a time.
HELD_WORDS = 200_000
HELD_NEIGHBOURS = 1 << 20
#: Reduced words whose neighbourhoods one task makes.
TASK_CLASSES = 20_000

_ODD = 0x9E3779B97F4A7C15

#: Letters of a word by their Latin-1 codes; the multiplication and the division sign count, too.
#: A byte of any other character becomes a space. Latin-1 has a code for exactly those letters.
_LETTERS = bytes(
    code if 65 <= code <= 90 or 97 <= code <= 122 or code >= 0xC0 else 32 for code in range(256)
)


def counted(doc_id: int | None, text: str | None) -> tuple[list[bytes], list[tuple[bytes, bytes, int]]]:
    """Runs of a text, lower-cased, in Latin-1; and (run, run without a letter, times) for the damaged ones.

    The hash of a null doc_id is that of no digits.
    """
    if not text:
        return [], []
    runs = text.encode("latin-1", "replace").lower().translate(_LETTERS).split()
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    damaged = []
    for run in set(runs):
        sign = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if not sign % TYPO_EVERY:
            at = sign % len(run)
            damaged.append((run, run[:at] + run[at + 1 :], runs.count(run)))
    return runs, damaged


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word of LEAST_LENGTH or more code points occurs in all texts.

    Each task counts before anything is shuffled, so a frequent word is a few rows.
    """

    def run(batches):
        held = Counter()

        def flush():
            long = [(w.decode("latin-1"), n) for w, n in held.items() if n and len(w) >= LEAST_LENGTH]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())],
                ["word", "n"],
            )

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                runs, damaged = counted(doc_id, text.as_py())
                held.update(runs)
                for old, new, times in damaged:
                    held[old] -= times
                    held[new] += times
                if len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    rows = shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _symbols(symbols: int) -> np.ndarray:
    """Symbol (1 to ``symbols``) of each Latin-1 letter."""
    return np.array(
        [xxhash.xxh32_intdigest(bytes([code])) % symbols + 1 for code in range(256)], np.uint64
    )


def _base(symbols: int) -> int:
    """Words are numbers in this base: distinct as long as they fit in 64 bits, else hashed."""
    return symbols + 1


def reduced(words: list[str], symbols: int) -> list[np.ndarray]:
    """The symbols of each word."""
    table = _symbols(symbols)
    return [table[np.frombuffer(w.encode("latin-1", "replace"), np.uint8)] for w in words]


def _powers(n: int, symbols: int) -> np.ndarray:
    powers = np.full(n + 1, _base(symbols), np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def code(word: np.ndarray, symbols: int) -> np.ndarray:
    """Number of a reduced word; no symbol is zero, so words of unlike length differ, too."""
    return (word * _powers(len(word), symbols)[: len(word)]).sum(dtype=np.uint64)


def neighbourhood(word: np.ndarray, symbols: int) -> np.ndarray:
    """Numbers of a reduced word and of all that one edit makes of it, each once.

    Of equal deletions and insertions in a run of one symbol the first is made.
    """
    n = len(word)
    powers = _powers(n + 1, symbols)
    parts = word * powers[:n]
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
    whole = before[-1]
    repeats = np.concatenate([[False], word[1:] == word[:-1]])
    # Behind a deleted symbol the rest moves down one place: as numbers, so without division.
    moved = np.concatenate([np.cumsum((word[1:] * powers[: n - 1])[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)])
    deleted = (before[:-1] + moved)[~repeats]
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    other = letters[None, :] != word[:, None]
    replaced = (whole - parts[:, None] + letters[None, :] * powers[:n, None])[other]
    # Before place i, the rest moves up one place; after the same symbol it was made already.
    up = before[:, None] + letters[None, :] * powers[: n + 1, None] + ((whole - before) * np.uint64(_base(symbols)))[:, None]
    fresh = np.ones((n + 1, symbols), bool)
    fresh[1:][~other] = False
    return np.concatenate([np.array([whole]), deleted, replaced, up[fresh]])


def reduced_words(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(word, n, class): the vocabulary with the number of each word's reduced form."""

    def run(batches):
        for batch in batches:
            codes = [code(w, symbols) for w in reduced(batch.column("word").to_pylist(), symbols)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(codes, np.uint64).view(np.int64))], ["word", "n", "class"]
            )

    return shipped(vocabulary).select("word", "n").mapInArrow(run, "word string, n long, class long")


def neighbourhoods(classes: DataFrame, symbols: int) -> DataFrame:
    """(class, other): each class with the numbers of its full one-edit neighbourhood.

    ``classes`` has one ``word`` of each class.
    """

    def run(batches):
        def made(owners, found):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(owners, np.int64), list(map(len, found)))),
                 pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], ["class", "other"],
            )

        for batch in batches:
            owners, found, held = [], [], 0
            for owner, word in zip(
                batch.column("class").to_pylist(), reduced(batch.column("word").to_pylist(), symbols), strict=True
            ):
                owners.append(owner)
                found.append(neighbourhood(word, symbols))
                held += len(found[-1])
                if held > HELD_NEIGHBOURS:
                    yield made(owners, found)
                    owners, found, held = [], [], 0
            yield made(owners, found)

    return shipped(classes).select("class", "word").mapInArrow(run, "class long, other long")


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) of all pairs of words that differ by exactly one edit, both ways round.

    ``vocabulary`` has (word, n), each word once, and is stored.
    """
    words = store(reduced_words(vocabulary, symbols), "spelling-reduced")
    classes = store(words.groupBy("class").agg(F.min("word").alias("word")), "spelling-classes")
    tasks = max(1, -(-classes.count() // TASK_CLASSES))
    meet = store(
        neighbourhoods(classes.repartition(tasks, "class"), symbols)
        .join(classes.select(F.col("class").alias("other")), "other").select("class", "other").distinct(),
        "spelling-meet",
    )
    others = words.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("class").alias("other")
    )
    asked = words.join(meet, "class").select("word", "n", "other").alias("a")
    # Verified inside the join: only true pairs come out of it.
    one_edit = (F.col("a.other") == F.col("b.other")) & (F.levenshtein("word", "near", 1) == 1)
    return asked.join(others.alias("b"), one_edit).select("word", "n", "near", "near_n")


def forms(vocabulary: DataFrame, pairs: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, form, form_n, n_near) of each word; form is null where no near word is frequent enough.

    Of near words equally frequent the first in code-point order counts.
    """
    best = pairs.groupBy("word").agg(
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
        F.count(F.lit(1)).alias("n_near"),
    )
    frequent = -F.col("best.less") >= dominance * F.col("n")
    return vocabulary.join(best, "word", "left").select(
        "word", "n", F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def rooted(words: DataFrame) -> DataFrame:
    """``words`` (word, form, ...) with root, the last word reached by following the forms.

    Pointers are doubled: each round every word takes over where its target points. A form is at
    least twice as frequent as its word, so there are no circles and few rounds.
    """
    links = store(words.select("word", F.col("form").alias("root")).where("form is not null"), "spelling-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        new = store(
            links.join(ahead, "root", "left").select(
                "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")
            ), "spelling-links",
        )
        links = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    return words.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the vocabulary of ``docs`` (doc_id, text).

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased; the
    rule of ``counted`` damages some. The vocabulary are those of at least LEAST_LENGTH code
    points and LEAST_COUNT occurrences. A null or empty text has no words; a repeated row counts again;
    an empty table, or one without frequent words, gives no rows; other columns are not looked at.
    A word that nothing is near has no form, zero near words, and is its own root.
    """
    vocabulary = store(word_counts(docs).where(F.col("n") >= LEAST_COUNT), "spelling-words")
    pairs = near_words(vocabulary, symbols)
    words = store(forms(vocabulary, pairs), "spelling-forms")
    return rooted(words).select("word", "form", "root", "n", "n_near", "form_n")

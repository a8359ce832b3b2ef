"""Benchmark passages in documents, also reworded: latent search, then common subsequences and answers.

Passages of documents and benchmark items become TF-IDF vectors over hashed words. A randomised
singular value decomposition (one pass over the passages, combined from partition sums) gives a latent
space; passages near an item there, by cosine, are candidates. A candidate counts if item and text share a long
subsequence of words and, where the item names its answer, the answer is there too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

from threadloom.llm.arrow import add_columns, blocks, raw, release, without
from threadloom.llm.sums import summed
from threadloom.session import stored

#: Hashed words, latent dimensions, and words in half a passage; passages overlap by half.
BUCKETS, RANK, HALF = 8192, 96, 32
#: Least cosine of a passage and a piece of an item of so many words; less for shorter items.
COSINE = 0.55
#: Shares of an item's words, and of its answer's words, that must follow in order.
ITEM_SHARE, ANSWER_SHARE = 0.7, 0.5
#: Items searched in one pass; more items take more passes.
BLOCK_ITEMS = 20_000
SEED = 11
CACHE_WORDS = 200_000
BLOCK = 2 << 20
SLICE = 256
#: ASCII letters in lower case; digits and bytes beyond ASCII stay; all else parts words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Hasher(dict):
    """Bucket of each word, remembered while the task runs."""

    def __missing__(self, word: bytes) -> int:
        made = self[word] = zlib.crc32(word) % BUCKETS
        return made

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint16, len(words))


#: Buckets of a text's words in two bytes each, as ``hashed`` adds them.
HASHED = "__word_buckets"


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its words' buckets, stored: ``fit`` and ``mark`` read them instead of splitting texts again."""

    def make():
        hasher = Hasher()
        return lambda values: [pa.array([hasher(words_of(t)).tobytes() for t in raw(values)], pa.binary())]

    return stored(add_columns(docs, text, [StructField(HASHED, BinaryType())], make, BLOCK), "words")


def _buckets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint16) for v in column.to_pylist()]


@dataclass
class Halves:
    """Words of a block of texts in rows of ``HALF`` words; a row never crosses texts. Bucket
    ``BUCKETS`` fills up the last row of a text."""

    tokens: np.ndarray
    owner: np.ndarray
    first_word: np.ndarray

    @classmethod
    def cut(cls, texts: list[np.ndarray]) -> Halves:
        sizes = np.array([len(t) for t in texts], np.int64)
        runs = -(-sizes // HALF)
        owner = np.repeat(np.arange(len(texts)), runs)
        first_run = np.cumsum(runs) - runs
        tokens = np.full(int(runs.sum()) * HALF, BUCKETS, np.uint16)
        if len(texts):
            place = np.arange(sizes.sum()) + np.repeat(first_run * HALF - (np.cumsum(sizes) - sizes), sizes)
            tokens[place] = np.concatenate(texts)
        return cls(tokens.reshape(-1, HALF), owner, (np.arange(len(owner)) - first_run[owner]) * HALF)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """For each row the sum of its words' rows in ``table``, in slices that fit a cache."""
        table = np.vstack([table, np.zeros((1, table.shape[1]))]).astype(np.float32)
        made = np.empty((len(self.tokens), table.shape[1]), np.float32)
        for a in range(0, len(made), SLICE):
            table[self.tokens[a : a + SLICE]].sum(1, out=made[a : a + SLICE])
        return made

    def pairs(self) -> np.ndarray:
        """Rows that the next row of the same text follows: with it they are a passage."""
        return np.flatnonzero(self.owner[1:] == self.owner[:-1])


def scaled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    size = np.where(size > 1e-12, size, 1)
    return rows / size, size


def product(halves: Halves, table: np.ndarray, idf: np.ndarray, total: np.ndarray) -> float:
    """Add the passages' share of A'(A G) to ``total``, where ``table`` is G scaled by idf; number of passages."""
    if not len(halves.tokens):
        return 0.0
    sums = halves.sums(table)
    pairs = halves.pairs()
    alone = np.ones(len(sums), bool)
    alone[pairs] = alone[pairs + 1] = False
    back = np.zeros_like(sums)
    rows, size = scaled(sums[pairs] + sums[pairs + 1])
    rows /= size
    back[pairs] += rows
    back[pairs + 1] += rows
    rows, size = scaled(sums[alone])
    back[alone] = rows / size
    buckets = halves.tokens.ravel().astype(np.int64)
    weights = np.append(idf, 0.0)
    for column, part in zip(total.T, np.ascontiguousarray(back.T, float)):
        column[: BUCKETS + 1] += np.bincount(buckets, np.repeat(part, HALF), BUCKETS + 1) * weights
    return float(len(pairs) + alone.sum())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Halves]:
    for batch in batches:
        # Two bytes a word are about a third of the text.
        for block in blocks(batch, BLOCK // 3):
            yield Halves.cut(_buckets(block.column(0)))
    release()


def holders(texts: DataFrame) -> tuple[np.ndarray, float]:
    """For each bucket the number of half passages that hold it, and their number."""

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(BUCKETS + 1)
        for halves in _texts(batches):
            rows = np.sort(halves.tokens, 1)
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            total[:-1] += np.bincount(rows[new], minlength=BUCKETS + 1)[:-1]
            total[-1] += len(rows)
        return total

    found = summed(texts, BUCKETS + 1, partial)
    return found[:-1], found[-1]


def normal_product(texts: DataFrame, directions: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, float]:
    """A'(A G) for the passages of all texts, summed over tasks by bucket, and the number of passages."""
    table = (directions * idf[:, None]).astype(np.float32)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS + 1, RANK))
        passages = 0.0
        for halves in _texts(batches):
            passages += product(halves, table, idf, total)
        total[-1] = 0
        total[-1, 0] = passages
        rows = np.flatnonzero(total.any(1))
        for a in range(0, len(rows), 2048):
            part = rows[a : a + 2048]
            columns = [pa.array(part), *(pa.array(np.ascontiguousarray(c, np.float32)) for c in total[part].T)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["bucket", *(f"v{i}" for i in range(RANK))]
    schema = "bucket long, " + ", ".join(f"{n} float" for n in names[1:])
    found = texts.mapInArrow(partial, schema).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names[1:])).toArrow()
    made = np.zeros((BUCKETS + 1, RANK))
    made[found["bucket"].to_numpy()] = np.column_stack([found[n].to_numpy() for n in names[1:]])
    return made[:-1], float(made[-1, 0])


@dataclass(frozen=True)
class Latent:
    """Rows of ``table`` take a word to the latent space, weighted by its inverse frequency and with
    every direction scaled to like strength."""

    table: np.ndarray


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text") -> Latent:
    """The latent space of all passages of documents and benchmark, either half weighing alike.

    Randomised: Y = (A'A) G for a random G of ``RANK`` columns, then the Nyström form of the singular
    value decomposition of A. Without any words the space is that of G itself. ``docs`` may come from ``hashed``.
    """
    corpus = (docs if HASHED in docs.columns else hashed(docs.select(text), text)).select(HASHED)
    items = hashed(benchmark.select(item_text), item_text).select(HASHED)
    (held, count), (item_held, item_count) = holders(corpus), holders(items)
    idf = np.log1p((count + item_count + 1) / (held + item_held + 1))
    random = np.linalg.qr(np.random.default_rng(SEED).standard_normal((BUCKETS, RANK)))[0]
    # Scaled so that projected lengths estimate lengths.
    random *= (BUCKETS / RANK) ** 0.5
    (y, passages), (z, item_passages) = normal_product(corpus, random, idf), normal_product(items, random, idf)
    y = y / max(passages, 1) + z / max(item_passages, 1)
    shift = 1e-6 * max(np.linalg.norm(y), 1e-9)
    y = y + shift * random
    core = random.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * values[-1]
    singular, strength, _ = np.linalg.svd(y @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    # By its strength each direction counts alike; else those of common words would hide all others.
    return Latent((singular / np.maximum(strength, 1e-6 * strength[0]) * idf[:, None]).astype(np.float32))


def common(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bits."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for x in b:
        hit = rest & where.get(x, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return len(a) - rest.bit_count()


@dataclass(frozen=True)
class Items:
    ids: list
    words: list[list[bytes]]
    answers: list[list[bytes]]
    owner: np.ndarray
    offset: np.ndarray
    vectors: np.ndarray
    least: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple], latent: Latent) -> Items:
        texts = [(i, (t or "").encode(), (a or "").encode()) for i, t, a in rows]
        words = [words_of(t) for _, t, _ in texts]
        answers = [words_of(a) for _, _, a in texts]
        hasher = Hasher()
        # Pieces of HALF words, the last one moved back to be as long; a short item is one piece.
        pieces = [
            (i, at, hasher(w[at : at + HALF]))
            for i, w in enumerate(words)
            for at in sorted({*range(0, len(w) - HALF + 1, HALF), max(0, len(w) - HALF)})
            if w
        ]
        owner, offset = (np.array([p[k] for p in pieces], int) for k in (0, 1))
        sizes = np.array([len(p[2]) for p in pieces])
        halves = Halves.cut([p[2] for p in pieces])
        vectors = scaled(halves.sums(latent.table))[0].astype(np.float32)
        # A short item is a smaller part of the passage around it.
        least = (COSINE * np.sqrt(sizes / HALF)).astype(np.float32)
        return cls([i for i, _, _ in texts], words, answers, owner, offset, vectors, least)


def matched(item: list[bytes], answer: list[bytes], text: list[bytes]) -> tuple[float, float | None] | None:
    """Shares of the item and of its answer, None for one without words; None where a share is too small."""
    there = set(text)
    if sum(w in there for w in item) < ITEM_SHARE * len(item):
        return None
    share = common(item, text) / len(item)
    if share < ITEM_SHARE:
        return None
    if not answer:
        return share, None
    answered = common(answer, text) / len(answer)
    return (share, answered) if answered >= ANSWER_SHARE else None


def near_passages(halves: Halves, items: Items, latent: Latent) -> dict[tuple[int, int], dict[int, float]]:
    """Candidates: for (text, item) the first words of near passages and their cosines."""
    sums = halves.sums(latent.table)
    pairs = halves.pairs()
    found: dict[tuple[int, int], dict[int, float]] = {}
    for rows, runs in ((sums, np.arange(len(sums))), (sums[pairs] + sums[pairs + 1], pairs)):
        for a in range(0, len(rows), SLICE):
            cosines = scaled(rows[a : a + SLICE])[0] @ items.vectors.T
            near = np.flatnonzero(cosines >= items.least)
            for i, j in zip((near // len(items.least)).tolist(), (near % len(items.least)).tolist()):
                run = runs[a + i]
                at = int(halves.first_word[run]) - int(items.offset[j])
                hits = found.setdefault((int(halves.owner[run]), int(items.owner[j])), {})
                hits[at] = max(hits.get(at, 0.0), float(cosines[i, j]))
    return found


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    latent: Latent,
    text: str = "text",
    out: str = "matches",
    item_id: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
) -> DataFrame:
    """``docs`` with the benchmark items of each whole text in ``out``: item, shares, best cosine.

    Without a column ``answer``, or where it holds no words, the item's own share decides alone and the answer's is
    null. Items with null or no words match nothing, null and empty texts hold none; repeated items are
    reported each. Items are broadcast in blocks of at most ``BLOCK_ITEMS`` rows, one pass over ``docs``
    for each block. A column named ``out`` is replaced.
    """
    chosen = benchmark.select(
        F.col(item_id).alias("item"), F.col(item_text).alias("text"), (F.col(answer) if answer else F.lit("")).alias("a")
    ).filter("length(text) > 0")
    passes = max(1, -(-chosen.count() // BLOCK_ITEMS))
    kind = StructType(
        [chosen.schema["item"], *(StructField(n, DoubleType()) for n in ("item_share", "answer_share", "cosine"))]
    )
    field = StructField(out, ArrayType(kind))

    def marked(df: DataFrame, part: int, name: str) -> DataFrame:
        rows = chosen.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == part)
        items = Items.of([tuple(r) for r in rows.orderBy("item", "text").collect()], latent)
        item_type = pa.list_(
            pa.struct([("item", pa.array(items.ids).type if items.ids else pa.int64())]
                      + [(n, pa.float64()) for n in ("item_share", "answer_share", "cosine")])
        )

        def make():
            def block(values: pa.Array, buckets: pa.Array) -> list[pa.Array]:
                halves = Halves.cut(_buckets(buckets))
                made: list[list[dict]] = [[] for _ in range(len(values))]
                words: dict[int, list[bytes]] = {}
                if len(halves.tokens) and len(items.least):
                    for (i, j), hits in sorted(near_passages(halves, items, latent).items()):
                        if i not in words:
                            # Only texts with a candidate are split.
                            words = {i: words_of((values[i].as_py() or "").encode())}
                        best = None
                        for at, cosine in hits.items():
                            size = len(items.words[j])
                            around = words[i][max(0, at - HALF - size // 4) : at + size + 2 * HALF + size // 4]
                            shares = matched(items.words[j], items.answers[j], around)
                            if shares and (best is None or (*shares, cosine) > best):
                                best = (*shares, cosine)
                        if best:
                            made[i].append(dict(zip(("item", "item_share", "answer_share", "cosine"), (items.ids[j], *best))))
                return [pa.array(made, item_type)]

            return block

        keep = without(df, [name, HASHED]) if part == passes - 1 else without(df, [name])
        return add_columns(df, text, [StructField(name, field.dataType)], make, BLOCK, keep, [HASHED])

    docs = docs if HASHED in docs.columns else hashed(docs, text)
    if passes == 1:
        return marked(docs, 0, out)
    names = [f"__matches{i}" for i in range(passes)]
    for i, name in enumerate(names):
        docs = marked(docs, i, name)
    return docs.withColumn(out, F.concat(*names)).drop(*names)

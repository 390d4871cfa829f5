"""Spelling variants through k-d trees over letter counts.

*Words.*  Maximal runs of Latin letters of whole texts, A-Z lower-cased, are
counted over all documents; tasks add up before the shuffle.

*Near words.*  Two words are near at exactly one inserted, deleted or
replaced letter.  One edit moves the vector of letter counts by an L1
distance of at most two: a replaced letter is one count up and one down, an
inserted letter one count up.  So words are searched by pairs of lengths (n
with n, n with n + 1) in k-d trees over letter counts: a search carries what
it may still move up and down, and enters the far side of a cut only by
spending it, which prunes the boxes out of reach.  In the leaves a matrix
product of unary counts gives the common letters; where they are enough, the
order of the letters is verified.

*Spark.*  The top of each length's tree is cut on the driver from a sample
of ``SAMPLE_WORDS`` words, into cells of about ``CELL_LETTERS`` letters.
The sample only balances: every word is stored in its cell and sent to each
cell that its search reaches.  Cells that hold more are split into parts,
and so are the searches sent to a crowded cell; each part of the one meets
each part of the other.  A task then builds the lower tree of its part.

*Forms.*  A word's form is its most frequent near word, if that is ``ratio``
times as frequent; roots follow forms to the last by doubling steps, each a
written table (frequency grows along them, so there are no circles).

Defined results: null and empty texts have no words; a null id counts as an
empty one in a change of runs; repeated rows are counted again; ties of
frequency go to the smaller word in code-point order; an empty table gives
an empty result; further columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import ship, written

SAMPLE_WORDS = 1 << 16
CELL_LETTERS = 1 << 18
LEAF_WORDS = 64
#: Words that a task counts before it passes them on.
COUNTED = 400_000
#: Pairs verified at once.
PAIRS = 1 << 20

_LETTERS = 256  # letters are the code points of Latin-1


# -- words -------------------------------------------------------------------
def drop_one_letter(doc_id: object, run: str) -> str:
    """The contract's change: by the run's hash, one code point goes."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % 31:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, least_count: int = 2,
                change: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): letter runs of all texts, changed by ``change``."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, least_letters))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(runs.findall((text.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                for run, n in found.items():
                    word = change(key, run) if change else run
                    if len(word) >= least_letters:
                        seen[word] += n
                if len(seen) >= COUNTED:
                    yield batch_of(seen)
                    seen.clear()
        yield batch_of(seen)

    def batch_of(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    parts = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- trees -------------------------------------------------------------------
def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    cells = np.arange(len(codes))[:, None] * _LETTERS + codes
    return np.bincount(cells.ravel(), minlength=len(codes) * _LETTERS).reshape(-1, _LETTERS).astype(np.int32)


class Cut:
    """An inner node: words with at most ``most`` of ``letter`` are below."""

    def __init__(self, letter: int, most: int, below, above):
        self.letter, self.most, self.below, self.above = letter, most, below, above


def build(counts: np.ndarray, leaf_words: float):
    """A k-d tree over all rows; leaves are arrays of rows.  Each cut is the
    letter and count that halve the rows best."""
    used = np.flatnonzero(counts.any(0))
    small = counts[:, used]

    def part(at: np.ndarray):
        if len(at) <= leaf_words:
            return at
        own = small[at]
        best = None
        for most in range(int(own.max())):
            share = (own > most).sum(0)
            letter = int(np.abs(2 * share - len(at)).argmin())
            off = abs(2 * int(share[letter]) - len(at))
            if best is None or off < best[0]:
                best = (off, letter, most)
            if not (share > len(at) // 2).any():
                break  # higher counts are rarer still
        if best is None or best[0] >= len(at):
            return at  # all alike
        above = own[:, best[1]] > best[2]
        return Cut(int(used[best[1]]), best[2], part(at[~above]), part(at[above]))

    return part(np.arange(len(counts)))


def search(node, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[object, np.ndarray]]:
    """(leaf, rows of ``counts`` that reach it) for searches that may move
    ``up`` counts up and ``down`` counts down, by one each.  Of two moves the
    letter that goes up has to be the smaller one: words with one letter
    replaced find each other from one side."""
    n = len(counts)
    none_up, none_down = 0, _LETTERS  # else the letter moved
    todo = [(node, np.arange(n), np.full(n, none_up if up else _LETTERS, np.int16), np.full(n, none_down if down else -1, np.int16))]
    while todo:
        node, at, ups, downs = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, Cut):
            yield node, at
            continue
        own = counts[at, node.letter]
        letter = node.letter
        over = (own == node.most + 1) & (downs == none_down) & (ups < letter)  # the far side is one letter away
        go = (own <= node.most) | over
        todo.append((node.below, at[go], ups[go], np.where(over, letter, downs)[go]))
        over = (own == node.most) & (ups == none_up) & ((letter < downs) if down else True)
        go = (own > node.most) | over
        todo.append((node.above, at[go], np.where(over, letter, ups)[go], downs[go]))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each two words differ by one letter, smaller in ``b``."""
    off = a != b
    return (off.sum(1) == 1) & (b < a).any(1)


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each long word is the short one and one letter more."""
    head = (short == long[:, :-1]).cumprod(1).sum(1)
    tail = (short == long[:, 1:])[:, ::-1].cumprod(1).sum(1)
    return head + tail >= short.shape[1]


def near_pairs(homes: list[str], asked: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``asked``, place in ``homes``) of near words; all of
    ``homes`` have one length, all of ``asked`` the same (then the replaced
    letter is the smaller one in ``homes``) or one less."""
    stored, wanted = letters(homes), letters(asked)
    same = stored.shape[1] == wanted.shape[1]
    counts, own = letter_counts(stored), letter_counts(wanted)
    tree = build(counts, LEAF_WORDS)
    # unary counts of the letters: column (letter, k) is 1 where a word has more than k
    unary = [(letter, k) for letter in np.flatnonzero(counts.any(0)) for k in range(counts[:, letter].max())]
    right, left = np.empty((len(homes), len(unary)), np.uint8), np.empty((len(asked), len(unary)), np.uint8)
    for made, given in ((right, counts), (left, own)):
        for j, (letter, k) in enumerate(unary):
            np.greater(given[:, letter], k, out=made[:, j], casting="unsafe")
    common = wanted.shape[1] - same  # letters that near words have in common, whatever their order
    verify = one_replaced if same else one_inserted
    for leaf, at in search(tree, own, 1, int(same)):
        here = right[leaf].T.astype(np.float32)
        step, checked = max(1, PAIRS // len(leaf)), max(1, 16 * PAIRS // stored.shape[1])
        for i in range(0, len(at), step):
            part = at[i:i + step]
            a, b = np.nonzero(left[part].astype(np.float32) @ here == common)
            a, b = part[a], leaf[b]
            for j in range(0, len(a), checked):
                x, y = a[j:j + checked], b[j:j + checked]
                ok = verify(wanted[x], stored[y])
                if ok.any():
                    yield x[ok], y[ok]


# -- cells -------------------------------------------------------------------
def top_trees(sample: list[tuple[str, int]], letters_of: dict[int, int]) -> dict[int, object]:
    """The top of each length's tree: its leaves are numbers of cells."""
    words: dict[int, list[str]] = {}
    for w, size in sample:
        words.setdefault(size, []).append(w)
    out = {}
    for size, total in letters_of.items():
        own = words.get(size, [])
        cells = -(-total // CELL_LETTERS)
        counts = letter_counts(letters(own)) if own else np.zeros((0, _LETTERS), np.int32)
        tree = build(counts, max(1.0, len(own) / cells))
        out[size] = numbered(tree, [0])
    return out


def numbered(node, count: list[int]):
    """The tree with its leaves replaced by their numbers."""
    if isinstance(node, Cut):
        return Cut(node.letter, node.most, numbered(node.below, count), numbered(node.above, count))
    count[0] += 1
    return count[0] - 1


def cells_of(words: list[str], size: int, trees: dict[int, object]) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(length of the cell, its number, role, places of the words): role 0
    stores a word, role 1 searches words of its own length, 2 longer ones."""
    counts = letter_counts(letters(words))
    for role, at, up, down in ((0, size, 0, 0), (1, size, 1, 1), (2, size + 1, 1, 0)):
        if at in trees:
            for cell, places in search(trees[at], counts, up, down):
                yield at, cell, role, places


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of every two near words, both ways."""
    spark = words.sparkSession
    sized = words.select("word", "n", F.length("word").alias("size"))
    letters_of = {r["size"]: r["letters"] for r in sized.groupBy("size").agg(F.sum(F.col("size").cast("long")).alias("letters")).collect()}  # a row a length
    sample = sized.orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS)
    so_far = F.sum("size").over(_by_hash())
    some = [(r["word"], r["size"]) for r in sample.withColumn("so_far", so_far).where(F.col("so_far") <= 16 * SAMPLE_WORDS).select("word", "size").collect()]
    trees = top_trees(some, letters_of)

    def grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
        sizes = batch.column(2).to_numpy()
        words = np.array(batch.column(0).to_pylist(), object)
        for size in np.unique(sizes):
            places = np.flatnonzero(sizes == size)
            step = max(1, 4 * CELL_LETTERS // int(size))
            for i in range(0, len(places), step):
                part = places[i:i + step]
                for length, cell, role, at in cells_of(list(words[part]), int(size), trees):
                    yield length, cell, role, part[at]

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for length, cell, role, at in grouped(batch):
                total[length, cell, min(role, 1)] += int(batch.column(2).to_numpy()[at].sum())
        names = ["length", "cell", "role", "letters"]
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in total], t) for i, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.int32()))]
                                         + [pa.array(list(total.values()), pa.int64())], names=names)

    # Parts of crowded cells: a number a cell, of which there is one for CELL_LETTERS letters.
    load = sized.mapInArrow(loads, "length int, cell int, role int, letters long").groupBy("length", "cell", "role").agg(F.sum("letters").alias("letters"))
    limit = {0: 2 * CELL_LETTERS, 1: 16 * CELL_LETTERS}
    crowded = load.where(F.col("letters") > F.when(F.col("role") == 0, limit[0]).otherwise(limit[1])).collect()
    parts = {(r["length"], r["cell"], r["role"]): -(-r["letters"] // limit[r["role"]]) for r in crowded}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salt = np.fromiter((crc32(w.encode()) for w in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            for length, cell, role, at in grouped(batch):
                stored, asked = (parts.get((length, cell, r), 1) for r in (0, 1))
                part = batch.take(pa.array(at))
                own = salt[at] % (asked if role else stored)
                for other in range(stored if role else asked):
                    rest = np.full(len(at), other)
                    a, b = (rest, own) if role else (own, rest)
                    whole = lambda x: pa.array(np.full(len(at), x), pa.int32())
                    yield pa.RecordBatch.from_arrays([whole(length), whole(cell), pa.array(a, pa.int32()), pa.array(b, pa.int32()), whole(role), part.column(0), part.column(1)],
                                                     names=["length", "cell", "stored", "asked", "role", "word", "n"])

    def pairs(table: pa.Table) -> pa.Table:
        role = table["role"].to_numpy()
        words, n = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
        homes = np.flatnonzero(role == 0)
        out = []
        for kind in (1, 2):
            asked = np.flatnonzero(role == kind)
            if len(homes) and len(asked):
                for a, b in near_pairs(list(words[homes]), list(words[asked])):
                    a, b = asked[a], homes[b]
                    out.append((a, b))
                    out.append((b, a))
        a, b = (np.concatenate([o[i] for o in out]) if out else np.empty(0, int) for i in (0, 1))
        return pa.table({"word": pa.array(words[a], pa.string()), "near": pa.array(words[b], pa.string()), "near_n": pa.array(n[b], pa.int64())})

    return (sized.mapInArrow(sent, "length int, cell int, stored int, asked int, role int, word string, n long")
            .groupBy("length", "cell", "stored", "asked").applyInArrow(pairs, "word string, near string, near_n long"))


def _by_hash():
    from pyspark.sql.window import Window

    return Window.orderBy(F.xxhash64("word")).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) without circles."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = written(now, "roots")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left")
        if step.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per row of ``words`` (distinct ``word``, ``n``): ``word``,
    ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    if ratio < 2:
        raise ValueError("ratio: a form has to be more frequent than its word")
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near"))).alias("top"))
    joined = words.join(best, "word", "left")
    fits = -F.col("top.n") >= F.col("n") * ratio
    near = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                 F.when(fits, F.col("top.near")).alias("form"), F.when(fits, -F.col("top.n")).alias("form_n")), "near")
    last = roots(near.where(F.col("form").isNotNull()))
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ship(__name__)

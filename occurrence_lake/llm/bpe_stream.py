"""Byte-pair encoding and decoding as bounded-lookahead transducers.

*Sufficient lookahead.*  Run the merges of two texts that agree on a prefix
side by side, in rank order.  The agreed part can only shrink when a rule
(u, v) merges its last token u with something beyond it, by the length of
u; for a later rule (u', v') to shrink it again, v' has to begin with u.  So
the longest chain of rules of rising rank in which each right operand
begins with the left operand of an earlier one bounds how far a change
reaches back.  ``sufficient_lookahead`` computes that bound from the merge
list.  Tokens that end at least so many symbols before the end of the
buffer are stable: the transducer emits them, keeps the rest, and needs
constant memory for words of any length.

Texts are read in blocks cut at white space, which no pre-token crosses; in
longer runs without any, between two pre-tokens (a letter and a sign, digits,
a mark and a letter), or inside a run of letters or signs, whose pre-token
then goes on through the transducer with the next block.  This holds for the
scripts and signs listed below; a longer run of others is one block.  The ids
of each block go through an incremental decoder.

Defined results: null or empty text gives 0 tokens and the digests of the
empty string; repeated rows give repeated results; an empty table gives an
empty result; further columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from occurrence_lake.llm.common import process_cache, ship

BLOCK_CHARS = 1 << 16
BLOCK_SYMBOLS = 2048
KNOWN_WORDS = 250_000
KNOWN_WORD_CHARS = 128
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
#: Places to cut: before white space; where a pre-token ends for certain (a
#: contraction has at most two letters, a digit stands alone, a mark is no
#: letter); inside letters that neither compose with nor change case by their
#: neighbours; inside signs (an apostrophe could begin a contraction, unless
#: another follows).
_SPACE = re.compile("(?=[\t-\r \x85\xa0  -     　])")
_INDIC = ("अ-हঅ-ঌও-নপ-রশ-হஅ-ஊஎ-ஐம-ஹ"
          "అ-ఌఎ-ఐఒ-నప-ళก-ฮ")
_MARK = ("ँ-ःा-्ঁ-ঃা-ৄো-্ஂா-ூெ-ைொ-்"
         "ఁ-ఃా-ౄె-ైొ-్ิ-ฺ็-๎")
_BORDER = re.compile(r"(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])|(?<=[0-9])(?=[A-Za-z0-9])|(?<=[一-鿿])(?=[、。！，？])"
                     f"|(?<=[{_MARK}])(?=[{_INDIC}])")
_LETTER = (f"[A-Za-zÀ-ÖØ-öø-įı-ɏα-ρσ-ωΑ-ΡΤ-ΩЀ-џա-ֆא-ת"
           f"ء-غف-ي{_INDIC}ა-ჰぁ-ゖァ-ヺ一-鿿가-힣]")
_SIGN = "[!-&(-/:-@\\[-`{-~‐-‖‘-‧‰-※←-⇿─-◿、-〃〈-】\U0001f300-\U0001f64f\U0001f680-\U0001f6c5]"
_INSIDE = re.compile(f"(?<={_LETTER}{{3}})(?={_LETTER})|(?<={_SIGN}{{3}})(?={_SIGN})|(?<='{{3}})(?='')")
_MAPPED = "\ud800"  # marks a pre-token in the byte alphabet; no text holds a lone surrogate
_NO_RULE = 1 << 60


def byte_alphabet() -> list[str]:
    """Byte -> character of the byte-level alphabet: printable Latin-1
    characters stand for themselves, the other bytes for 256, 257, ..."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in shown}
    for i, b in enumerate(x for x in range(256) if x not in table):
        table[b] = chr(256 + i)
    return [table[b] for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], length=len) -> int:
    """Symbols beyond a token's end after which it cannot change any more."""
    best: dict[str, int] = {}
    most = 0
    for u, v in merges:
        chain = length(u) + max((best.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0)
        if chain > best.get(u, 0):
            best[u] = chain
            most = max(most, chain)
    return most


class Transducer:
    """Encoder of one word: ``feed`` symbols, collect stable tokens."""

    def __init__(self, ranks: dict[tuple[str, str], int], lookahead: int):
        self.ranks, self.lookahead = ranks, lookahead
        self.held: list[str] = []

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge in order of rank, leftmost first."""
        ranks = self.ranks
        if len(symbols) < 2:
            return symbols
        if len(symbols) <= 64:
            sym, get = list(symbols), ranks.get
            order = [get(p, _NO_RULE) for p in zip(sym, sym[1:])]
            while order and (low := min(order)) != _NO_RULE:
                i = order.index(low)
                sym[i:i + 2] = (sym[i] + sym[i + 1],)
                del order[i]
                if i:
                    order[i - 1] = get((sym[i - 1], sym[i]), _NO_RULE)
                if i < len(order):
                    order[i] = get((sym[i], sym[i + 1]), _NO_RULE)
            return sym
        sym = list(symbols)
        after = list(range(1, len(sym) + 1))
        before = list(range(-1, len(sym) - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(sym, sym[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, ""
            after[i] = k = after[j]
            if k < len(sym):
                before[k] = i
                if (p := (sym[i], sym[k])) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := before[i]) >= 0 and (p := (sym[h], sym[i])) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        return [s for s in sym if s]

    def feed(self, symbols: list[str], last: bool) -> list[str]:
        """Tokens that are now stable (all that remain, if ``last``)."""
        self.held += symbols
        tokens = self.merge(self.held)
        if last:
            self.held = []
            return tokens
        stable_to, at, n = len(self.held) - self.lookahead, 0, 0
        for n, t in enumerate(tokens):
            if at + len(t) > stable_to:
                break
            at += len(t)
        self.held = self.held[at:]
        return tokens[:n]


class TokenDecoder:
    """Incremental decoder as the vocabulary's own makes the text: token
    strings joined by one space.  Holds whether a token came before."""

    def __init__(self, tokens: dict[int, str]):
        self.tokens, self.sep = tokens, ""

    def feed(self, ids: Iterable[int]) -> str:
        if not (text := " ".join(map(self.tokens.__getitem__, ids))):
            return ""
        text, self.sep = self.sep + text, " "
        return text


class KnownWords(dict):
    """Pre-token -> (ids, ids joined by a space), filled as words come;
    forgets when it is full and keeps no long words."""

    def __init__(self, bpe: "WordBpe"):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> tuple[tuple[int, ...], str]:
        out = self.bpe.entry(self.bpe.encode_word(word))
        if len(word) <= KNOWN_WORD_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = out
        return out


class WordBpe:
    """A lower-casing byte-level BPE vocabulary with word ends, read from a
    tokenizer description file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.id_of = self.ids | self.special
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in reversed(list(enumerate(merges)))}
        size = lambda t: len(t.removesuffix(self.end))  # noqa: E731  symbols, the word end counts with its character
        self.lookahead = sufficient_lookahead(merges, size) + 1
        self.alphabet = byte_alphabet()
        self.bytes_of = {c: b for b, c in enumerate(self.alphabet)}
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        pieces = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(pieces[0]["pattern"]["Regex"])
        library = Tokenizer.from_file(path)  # its Unicode tables define letters, digits and case beyond ASCII
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.known = KnownWords(self)

    def pre_tokens(self, text: str) -> list[str]:
        """Normalised pre-tokens.  White space needs no collapsing, it only
        separates them.  Below U+0250 there is nothing to compose and the
        library's classes and lower case are Python's; beyond, the library
        normalises and splits (and gives the byte alphabet already)."""
        if not _BEYOND_LATIN.search(text):
            return self.words.findall(text.lower())
        return [_MAPPED + w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def symbols(self, word: str, last: bool = True) -> list[str]:
        symbols = list(word[1:]) if word[0] == _MAPPED else list(word) if word.isascii() and word.isprintable() else [self.alphabet[b] for b in word.encode()]
        if last:
            symbols[-1] += self.end
        return symbols

    def entry(self, tokens: Iterable[str]) -> tuple[tuple[int, ...], str]:
        ids = tuple(map(self.id_of.__getitem__, tokens))
        return ids, " ".join(map(str, ids))

    def encode_word(self, word: str, held: Transducer | None = None, last: bool = True) -> Iterator[str]:
        """Tokens of one pre-token (or, with ``held``, of a part of one),
        through the transducer in blocks."""
        t = held or Transducer(self.ranks, self.lookahead)
        symbols = self.symbols(word, last)
        step = max(BLOCK_SYMBOLS, 2 * self.lookahead)
        for i in range(0, len(symbols), step):
            yield from t.feed(symbols[i:i + step], last and i + step >= len(symbols))

    def cut(self, text: str, start: int) -> tuple[int, bool]:
        """(where to cut at ``start`` or soon after, whether that is inside a
        pre-token).  No special token is cut, and one ends a pre-token."""
        whole = lambda at, joined: all(text.find(s, max(0, at - len(s) + 1), at + len(s) - (not joined)) < 0 for s in self.special)
        while start < len(text):
            end = start + BLOCK_CHARS
            for places, joined in ((_SPACE, False), (_BORDER, False), (_INSIDE, True)):
                for m in places.finditer(text, start, end):
                    if whole(m.start(), joined):
                        return m.start(), joined
            start = end
        return len(text), False

    def blocks(self, text: str) -> Iterator[tuple[str, bool]]:
        """(block, whether its last pre-token goes on in the next one)."""
        at = 0
        while at < len(text):
            end, joined = self.cut(text, at + BLOCK_CHARS)
            yield text[at:end], joined
            at = end

    def stream(self, text: str) -> Iterator[list[tuple[tuple[int, ...], str]]]:
        """Block after block: (ids, ids joined by a space) of every
        pre-token, or of the stable tokens of one that goes on."""
        held: Transducer | None = None
        for block, joined in self.blocks(text):
            parts = self.split_special.split(block) if "<|" in block else [block]
            for k, part in enumerate(parts):
                if part in self.special:
                    yield [self.entry([part])]
                elif words := self.pre_tokens(part):
                    found, goes_on = [], joined and k == len(parts) - 1
                    if held:
                        alone = goes_on and len(words) == 1
                        found.append(self.entry(self.encode_word(words.pop(0), held, not alone)))
                        held = held if alone else None
                    tail = words.pop() if goes_on and words else None
                    found += map(self.known.__getitem__, words)
                    if tail is not None:
                        held = Transducer(self.ranks, self.lookahead)
                        found.append(self.entry(self.encode_word(tail, held, False)))
                    if found := [f for f in found if f[0]]:
                        yield found

    def encode(self, text: str) -> list[int]:
        return [i for found in self.stream(text) for ids, _ in found for i in ids]

    def decode_tokens(self, ids: Iterable[int]) -> Iterator[str]:
        """Pieces of the decoded text."""
        decoder = TokenDecoder(self.tokens)
        for i in ids:
            yield decoder.feed((i,))

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text: bytes through an incremental UTF-8 machine, each
        word end as one space.  Holds at most three pending bytes."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            token = self.tokens[i]
            if token in self.special:
                yield machine.decode(b"", True) + token
                machine.reset()
                continue
            word_end = token.endswith(self.end)
            token = token[:-len(self.end)] if word_end else token
            yield machine.decode(bytes(map(self.bytes_of.__getitem__, token)), word_end) + " " * word_end
        yield machine.decode(b"", True)

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids joined by a space, SHA-256
        of the text that the incremental decoder makes of the ids, block by
        block."""
        n, ids, decoded, decoder, sep = 0, hashlib.sha256(), hashlib.sha256(), TokenDecoder(self.tokens), ""
        for found in self.stream(text or ""):
            block_ids, id_parts = zip(*found)
            n += sum(map(len, block_ids))
            ids.update((sep + " ".join(id_parts)).encode())
            decoded.update(decoder.feed(chain.from_iterable(block_ids)).encode())
            sep = " "
        return n, ids.hexdigest(), decoded.hexdigest()


def encode_column(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``tokens`` (array of ids) of every row.  Map only."""
    id_type = df.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = process_cache(f"word-bpe:{path}", lambda: WordBpe(path))
        for batch in batches:
            for i in range(batch.num_rows):
                ids = bpe.encode(batch.column(1)[i].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32()))], names=["id", "tokens"])

    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        encoded, f"id {id_type}, tokens array<int>").withColumnRenamed("id", id_col)


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``.  Map only: no shuffle, nothing kept per text."""
    id_type = df.schema[id_col].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = process_cache(f"word-bpe:{path}", lambda: WordBpe(path))
        for batch in batches:
            got = [bpe.digests(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        digested, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


ship(__name__)

"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's characters are symbols; an agenda holds the adjacent pairs whose concatenation is a piece, by score and then
from the left, and the best pair is merged until none is left. Since no piece of such a vocabulary reaches over a
word's beginning, nor over a character that is in no longer piece, the agenda works on the segments between them, and
a worker remembers a bounded number of segments. The short segments of a batch that it doesn't remember are the rows of
one table of agendas, and each row takes its best pair in every round. Each such segment is checked against the
sentencepiece library: by itself if it begins a word, else behind a character that joins with nothing, or with its whole
text if it can't stand there; so is one whole text of each batch. A difference fails the job.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches, unused

SPACE = "▁"
#: Segments that a worker remembers in each of two generations.
REMEMBERED = 150_000
#: Segments of up to so many symbols share a table of agendas, in groups by length; a longer one has a heap of its own.
SHORT, WIDTHS = 32, (6, 8, 10, 12, 16, 24, 32)
#: Texts that are encoded together.
TEXTS = 256
#: A character of no vocabulary, behind which a segment is checked that doesn't begin a word.
STRANGE = "\ue000"


class Agenda:
    """The encoder of one model file."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        if any(map(sp.is_unused, range(n))):
            raise ValueError("unused pieces need resegmentation, which isn't supported")
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        # ranks stand for scores: a larger rank merges first; equal scores share a rank
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal}))}
        self.rank = {p: order[sp.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.bytes = [next((i for i in range(n) if sp.is_byte(i) and sp.id_to_piece(i) == f"<0x{b:02X}>"), None) for b in range(256)]
        self.unknown, self.fallback = sp.unk_id(), None not in self.bytes
        joined = {c for p in self.rank for c in p} - {SPACE}
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        if self.whole:
            self.segments = re.compile(r"(?s).+")  # a piece reaches over a word's beginning: the text is one segment
        else:
            inner = "".join(map(re.escape, sorted(joined))) or r"\Z"
            self.segments = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|(?s:.)")
        #: Segments' ids as decimal numbers joined by commas: a fraction of the memory of tuples.
        self.seen: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self._number(joined | {SPACE})
        there = sp.encode(STRANGE)
        self.strange = there if self.fallback and STRANGE not in joined and sp.normalize(STRANGE) == SPACE + STRANGE and there == list(self.to_ids([SPACE, STRANGE])) else None

    def _number(self, chars: set[str]) -> None:
        """Symbols as numbers, for the table of agendas: what each pair becomes, and with which rank. The last number is no symbol."""
        self.symbols = [*sorted(chars), *self.rank]
        number = {x: i for i, x in enumerate(self.symbols)}
        self.none = len(number)
        self.number_of = np.full(0x110000, self.none, np.int64)
        for c in chars:
            self.number_of[ord(c)] = number[c]
        self.id_of = np.array([*(self.ids.get(x, -1) for x in self.symbols), -1])
        found = sorted((number[p[:i]] * (self.none + 1) + number[p[i:]], r, number[p]) for p, r in self.rank.items() for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
        self.pairs, self.pair_rank, self.pair_made = np.array(found, np.int64).reshape(-1, 3).T.copy()

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and outcome of each pair; rank -1 for pairs that don't merge."""
        key = left * (self.none + 1) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], -1), self.pair_made[at]

    def together(self, segments: list[str]) -> list[tuple[int, ...]]:
        """The ids of many segments of at most SHORT known symbols each. A row of `rank` is a segment's agenda: entry i is the rank of
        the pair that begins at its symbol i; the first largest entry merges, in all rows at once, until no row has any."""
        if not len(self.pairs):
            return [self.to_ids(list(x)) for x in segments]
        n = np.fromiter(map(len, segments), np.int64, len(segments))
        rows, width = np.arange(len(segments)), int(n.max())
        symbol = np.full((len(rows), width + 1), self.none)
        symbol[np.arange(width + 1) < n[:, None]] = self.number_of[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        rank, made = self._pair(symbol[:, :-1], symbol[:, 1:])
        after, before = np.tile(np.arange(1, width + 2), (len(rows), 1)), np.tile(np.arange(-1, width), (len(rows), 1))
        while len(rows):
            i = rank[rows].argmax(axis=1)
            more = rank[rows, i] >= 0
            rows, i = rows[more], i[more]
            j = after[rows, i]
            k, h = after[rows, j], before[rows, i]
            symbol[rows, i], symbol[rows, j], after[rows, i], before[rows, k] = made[rows, i], self.none, k, i
            inner = j < width
            rank[rows[inner], j[inner]] = -1
            rank[rows, i], made[rows, i] = self._pair(symbol[rows, i], symbol[rows, k])
            left, h, i = rows[h >= 0], h[h >= 0], i[h >= 0]
            rank[left, h], made[left, h] = self._pair(symbol[left, h], symbol[left, i])
        alive = symbol != self.none
        ids, ends = self.id_of[symbol[alive]], np.cumsum(alive.sum(axis=1)).tolist()
        flat = ids.tolist()
        out = [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]
        for row in np.unique(np.nonzero(alive)[0][ids < 0]):  # symbols that are no piece: bytes or unknown
            out[row] = self.to_ids([self.symbols[x] for x in symbol[row][alive[row]]])
        return out

    def fresh_ids(self, segments: list[str]) -> dict[str, tuple[int, ...]]:
        """The ids of distinct segments. Those of several symbols hold only numbered characters, unless they are whole texts."""
        out = {x: self.to_ids(self._long(list(x))) for x in segments if len(x) == 1 or len(x) > SHORT or self.whole}
        segments = [x for x in segments if x not in out]
        low = 1
        for high in WIDTHS:
            if some := [x for x in segments if low < len(x) <= high]:
                out.update(zip(some, self.together(some)))
            low = high
        return out

    def _long(self, s: list[str]) -> list[str]:
        rank, n = self.rank.get, len(s)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(-r, i, s[i] + s[i + 1]) for i in range(n - 1) if (r := rank(s[i] + s[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, whole = heapq.heappop(agenda)
            j = after[i]
            if not s[i] or j < 0 or s[i] + s[j] != whole:
                continue  # one of the two has merged otherwise meanwhile
            s[i], s[j] = whole, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (r := rank(s[left] + s[right])) is not None:
                    heapq.heappush(agenda, (-r, left, s[left] + s[right]))
        return [x for x in s if x]

    def to_ids(self, symbols: list[str]) -> tuple[int, ...]:
        get = self.ids.get
        out: list[int] = []
        for x in symbols:
            i = get(x)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.bytes[b] for b in x.encode())
            elif not (out and out[-1] == self.unknown):  # the library merges neighbouring unknown symbols
                out.append(self.unknown)
        return tuple(out)

    def batch(self, texts: list[str]) -> list[str]:
        """Each text's ids, as decimal numbers joined by commas."""
        found = [self.segments.findall(self.sp.normalize(x)) for x in texts]
        if len(self.seen) > REMEMBERED:
            self.seen, self.older = {}, self.seen
        seen, older = self.seen, self.older
        unknown: dict[str, int] = {}
        for at, segments in enumerate(found):
            for x in segments:
                if x not in seen:
                    if (known := older.get(x)) is not None:
                        seen[x] = known
                    elif x not in unknown:
                        unknown[x] = at
        fresh = self.fresh_ids(list(unknown))
        for x, ids in fresh.items():
            seen[x] = ",".join(map(str, ids))
        out = [",".join([seen[x] for x in segments]) for segments in found]
        whole = sorted({*self.verify(fresh, unknown), *range(min(1, len(texts)))})
        for at, there in zip(whole, self.sp.encode([texts[i] for i in whole], num_threads=1)):
            if numbers(out[at]) != there:
                raise ValueError("the agenda and the library differ on a text")
        return out

    def verify(self, fresh: dict[str, tuple[int, ...]], at: dict[str, int]) -> set[int]:
        """Compare each segment with the library's encoding; the places of the texts that have to be compared as a whole instead."""
        begins = [x for x in fresh if len(x) > 1 and x[0] == SPACE]
        others = [x for x in fresh if not (len(x) > 1 and x[0] == SPACE)]
        alone = [x for x in others if self.strange and x[0] != SPACE and self.sp.normalize(STRANGE + x) == SPACE + STRANGE + x]
        for there, x in zip(self.sp.encode([x[1:].replace(SPACE, " ") for x in begins], num_threads=1), begins):
            if list(fresh[x]) != there:
                raise ValueError(f"the agenda and the library differ on {x!r}")
        for there, x in zip(self.sp.encode([STRANGE + x for x in alone], num_threads=1), alone):
            if [*self.strange, *fresh[x]] != there:
                raise ValueError(f"the agenda and the library differ on {x!r}")
        return {at[x] for x in {*others} - {*alone}}


def numbers(joined: str) -> list[int]:
    return list(map(int, joined.split(","))) if joined else []


@lru_cache(1)
def agenda(model: str) -> Agenda:
    return Agenda(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoder(model: str, with_ids: bool):
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = agenda(model)
        for batch in batches:
            rows = []
            gc.disable()  # the remembered segments hold no cycles, and looking for some in them costs a twentieth of the time
            try:
                for at in range(0, len(batch), TEXTS):
                    for joined in own.batch([x or "" for x in batch.iloc[at : at + TEXTS]]):
                        ids = numbers(joined)
                        text = own.sp.decode(ids)
                        rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), *([np.array(ids, np.int32)] if with_ids else [])))
            finally:
                gc.enable()
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    return F.pandas_udf(encode, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decoder(model: str):
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = agenda(model)
        for batch in batches:
            yield pd.Series([None if x is None else own.sp.decode([int(i) for i in x]) for x in batch], dtype=object)

    return F.pandas_udf(decode, "string")


def encode_texts(docs: DataFrame, model: str | None = None, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 and, with_ids, the ids.

    Null and empty texts have no tokens. Rows are independent, so repeated ids and rows, null ids and an empty table need
    no rule. A long text without spaces goes through a heap, so it costs n log n. Other columns stay; those of the
    names above are replaced.
    """
    text_batches(docs.sparkSession)
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    rows, own = docs.drop(*added), unused("encoded", docs)
    return rows.withColumn(own, encoder(model or default_model(), with_ids)(F.col(text_col))).select(*(F.col(f"`{c}`") for c in rows.columns), *(F.col(own)[c].alias(c) for c in added))


def decode_ids(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """rows with decoded: the ids' text; null for null ids."""
    return rows.withColumn("decoded", decoder(model or default_model())(F.col(ids_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with the digests of the ids and of the decoded text."""
    return encode_texts(docs.select("doc_id", "text")).drop("text")

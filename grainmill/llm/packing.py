"""Packing documents into sequences by swap-based local search.

A document is its tokens and an end id; only documents longer than a sequence are cut, into pieces of the full length
and a last piece. Full pieces are sequences of their own. All others are dealt by hash into even groups of about GROUP
pieces, and each group is packed on its own. The start is coarse: pieces in the order of a hash, a new bin whenever the
last one is too full, some fifth of the bins too many. Then the local search takes the emptiest underfull bin and moves
its pieces into others, or exchanges one for one or two for one, always the change that fills the other bin most. Every
step raises the sum of squared fills, so the search ends; bins that run empty go. It stops where the number of bins is
the least that the group's length allows, or where no change is left for any bin.

Null and empty texts are the end id alone. Pieces of equal length are alike to the search; the hash's order decides. Rows that repeat a document are packed each; an empty table gives an empty
result. Texts are tokenized whole. Extra columns play no part and are not returned.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import lean, written

LENGTH, END = 4096, 1
#: Pieces in a group: a group's packing wastes less than a bin, and one task holds a group.
GROUP = 20_000
#: Runs whose ids a worker keeps; beyond it, it starts anew and looks up the former ones before it works any out.
KEPT = 200_000
#: Marks that often end a run.
MARKS = ".,;:!?"


class WordIds(dict):
    """A run without white space -> its ids as little-endian unsigned 32-bit bytes.

    The vocabulary's own rules (NFC, lower case, split into words, merges up to the word's end) are followed with the
    merges as ranks; byte 0xFF, which no UTF-8 text has, marks the word's end. Runs with characters for which the
    libraries' case or classes might differ, or that hold one of the tokenizer's added tokens, go to the tokenizer itself.
    """

    PLAIN = regex.compile(r"[\x21-\x7e¡-ſ]+")
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    ODD = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.full = Tokenizer.from_file(path)
        model = json.load(open(path, encoding="utf-8"))["model"]
        added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.added = sorted({x for t in added for x in (t, unicodedata.normalize("NFC", t).lower())})
        self.quick = all(any(not c.isalpha() and c not in MARKS for c in t) for t in self.added)
        self.spaced = _any(t for t in added if regex.search(r"\s", t))
        shown = _byte_letters()
        raw = lambda token: b"".join(b"\xff" if x is None else bytes([shown[x]]) for x in _letters(token))
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {"".join(m): k for k, m in enumerate(merges)}
        singles = sorted((t for t in vocab if t not in made and len(list(_letters(t))) <= 2 and all(x is None or x in shown for x in _letters(t))), key=lambda t: (len(list(_letters(t))), vocab[t]))
        ranks = {raw(t): k for k, t in enumerate(singles)}
        ranks |= {raw(t): len(singles) + k for t, k in made.items() if t in vocab}
        self.ids = [b""] * (len(singles) + len(merges))
        for t in [*singles, *(t for t in made if t in vocab)]:
            self.ids[ranks[raw(t)]] = vocab[t].to_bytes(4, "little")
        self.words = _Words(tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}), ranks, self.ids)
        self.older: dict[str, bytes] = {}

    def __missing__(self, run: str) -> bytes:
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()
        out = self.older.get(run)
        if out is None:
            out = self._ids(run)
        self[run] = out
        return out

    def _ids(self, run: str) -> bytes:
        if self.quick and run.isascii():  # letters, or letters and a mark: what the pattern would part
            low = run.lower()
            if low.isalpha():
                return self.words[low]
            if low[-1] in MARKS and low[:-1].isalpha():
                return self.words[low[:-1]] + self.words[low[-1]]
        low = run.lower() if run.isascii() else unicodedata.normalize("NFC", run).lower()
        for token in self.added:
            if token in low or token in run:
                return self._full(run)
        if not run.isascii() and not self.PLAIN.fullmatch(run):
            return self._full(run)
        return b"".join(map(self.words.__getitem__, self.WORDS.findall(low)))

    def _full(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if any(c in text for c in self.ODD):  # str.split would part the text there, the tokenizer doesn't
            return self._full(text)
        if self.spaced and self.spaced.search(unicodedata.normalize("NFC", text)):  # and there too
            return self._full(text)
        return b"".join(map(self.__getitem__, text.split()))


class _Words(dict):
    """A word of the vocabulary's alphabet -> its ids, by merges."""

    def __init__(self, bpe, ranks: dict[bytes, int], ids: list[bytes]):
        super().__init__()
        # a release of the library without this call gets its merges from the ranks
        self.merged, self.ids = getattr(bpe, "_encode_single_piece", None) or _merger(ranks), ids

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        out = self[word] = b"".join([self.ids[r] for r in self.merged(word.encode() + b"\xff")])
        return out


def _merger(ranks: dict[bytes, int]):
    """Byte-pair encoding of one word: the pair of least rank is merged until none is left."""

    def merged(word: bytes) -> list[int]:
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((ranks.get(a + b, len(ranks) + len(word)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if parts[i] + parts[i + 1] not in ranks:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    return merged


def _any(tokens: Iterable[str]) -> regex.Pattern | None:
    """Finds any of the tokens, in any case and with any white space for theirs; None without tokens."""
    found = [r"\s+".join(regex.escape(x) for x in regex.split(r"\s+", unicodedata.normalize("NFC", t))) for t in tokens]
    return regex.compile("|".join(found), regex.IGNORECASE) if found else None


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies show for each byte: itself if printable, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _letters(token: str) -> Iterator[str | None]:
    yield from token.removesuffix("</w>")
    if token.endswith("</w>"):
        yield None


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordIds(vocabulary or default_vocabulary()), np.uint32(end).tobytes()
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            ids = batch.column(0).to_pylist()
            for doc, text in zip(ids, batch.column(1)):
                body = words.of(text.as_py() or "") + last
                for k in range(-(-len(body) // (4 * length))):
                    part = body[4 * length * k : 4 * length * (k + 1)]
                    for column, x in zip(out, (doc, k, length * k, len(part) // 4, zlib.crc32(part))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names)

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def next_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of indexes, in the order of the pieces: a new bin when the last one is too full. The search's coarse start."""
    bins: list[list[int]] = []
    room = -1
    for i, size in enumerate(sizes.tolist()):
        if size > room:
            bins.append([])
            room = length
        bins[-1].append(i)
        room -= size
    return bins


class Bins:
    """Underfull bins, indexed by their rooms and by what they would take in exchange for one of their pieces. Sets of
    numbers are kept as bits of one number, so that the tightest place is found without a walk over the bins."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], length: int):
        self.size, self.length, self.bins = sizes.tolist(), length, [list(b) for b in bins]
        self.fill = [sum(self.size[i] for i in b) for b in self.bins]
        self.steps = {"moves": 0, "one for one": 0, "two for one": 0}
        self.rooms: dict[int, dict[int, None]] = {}
        self.trades: dict[int, dict[tuple[int, int], None]] = {}
        self.some_room = self.some_trade = 0
        for b in range(len(self.bins)):
            self._list(b)

    def _entries(self, b: int) -> tuple[int, set[int]]:
        return self.length - self.fill[b], {self.size[i] for i in self.bins[b]}

    def _list(self, b: int) -> None:
        room, held = self._entries(b)
        if room and held:
            self.rooms.setdefault(room, {})[b] = None
            self.some_room |= 1 << room
            for s in held:
                self.trades.setdefault(room + s, {})[b, s] = None
                self.some_trade |= 1 << (room + s)

    def _unlist(self, b: int) -> None:
        room, held = self._entries(b)
        if room and held:
            del self.rooms[room][b]
            if not self.rooms[room]:
                self.some_room &= ~(1 << room)
            for s in held:
                del self.trades[room + s][b, s]
                if not self.trades[room + s]:
                    self.some_trade &= ~(1 << (room + s))

    def _move(self, size: int, most: int) -> tuple | None:
        """(room left, bin, None): the tightest bin that takes the size, if less than `most` is left there."""
        able = self.some_room >> size
        left = (able & -able).bit_length() - 1
        return (left, next(iter(self.rooms[size + left])), None) if able and left < most else None

    def _trade(self, size: int, most: int) -> tuple | None:
        """(room left, bin, size given back): as _move, against a smaller piece of the bin."""
        able, left = self.some_trade >> size, 0
        while able:
            step = (able & -able).bit_length() - 1
            left += step
            if left >= most:
                return None
            for b, s in self.trades[size + left]:
                if s < size:
                    return left, b, s
            able >>= step + 1
            left += 1
        return None

    def _change(self, source: int) -> tuple | None:
        """The move, one-for-one or two-for-one exchange that fills another bin most, and fuller than source is now, which
        is when the sum of squared fills grows: (room left, bin, size given back), pieces given, kind."""
        most, best = self.length - self.fill[source], None
        ones = {self.size[i]: i for i in self.bins[source]}
        for kind, find in (("moves", self._move), ("one for one", self._trade)):
            for size, i in ones.items():
                if most and (found := find(size, most)):
                    best, most = (found, (i,), kind), found[0]
        if best is None:
            seen = set()
            for x, i in enumerate(self.bins[source]):
                for j in self.bins[source][:x]:
                    size = self.size[i] + self.size[j]
                    if size not in seen and most and (found := self._trade(size, most)):
                        best, most = (found, (i, j), "two for one"), found[0]
                    seen.add(size)
        return best

    def drain(self, source: int) -> bool:
        """Take pieces out of a bin as long as a change helps; whether it ran empty."""
        self._unlist(source)
        while self.bins[source] and (change := self._change(source)):
            (_, b, back), give, kind = change
            self._unlist(b)
            taken = [next(i for i in self.bins[b] if self.size[i] == back)] if back is not None else []
            for of, to, pieces_ in ((source, b, give), (b, source, taken)):
                for i in pieces_:
                    self.bins[of].remove(i)
                    self.bins[to].append(i)
                    self.fill[of] -= self.size[i]
                    self.fill[to] += self.size[i]
            self._list(b)
            self.steps[kind] += 1
        self._list(source)
        return not self.bins[source]


def search(sizes: np.ndarray, bins: list[list[int]], length: int) -> Bins:
    """Drain underfull bins, the emptiest first, until they are as few as their pieces allow or no change helps. Bins that
    run empty stay as empty lists."""
    held = Bins(sizes, bins, length)
    alive, least = len(bins), -(-int(sizes.sum()) // length)
    queue = [(held.fill[b], b) for b in range(len(bins))]
    heapq.heapify(queue)
    stuck, steps = [], -1
    while alive > least:
        if not queue:
            if sum(held.steps.values()) == steps:
                break  # no bin changed since all were tried
            queue, stuck, steps = [(held.fill[b], b) for b in stuck], [], sum(held.steps.values())
            heapq.heapify(queue)
        fill, b = heapq.heappop(queue)
        if not held.bins[b]:
            continue
        if fill != held.fill[b]:  # it took pieces meanwhile
            heapq.heappush(queue, (held.fill[b], b))
        elif held.drain(b):
            alive -= 1
            for x in stuck:
                heapq.heappush(queue, (held.fill[x], x))
            stuck = []
        else:
            stuck.append(b)
    return held


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = written(pieces(docs, vocabulary, length, end), "pieces")
    some = cut.where(F.col("length") < length)
    groups = max(1, -(-some.count() // GROUP))

    @lean
    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ids_crc32", "doc_id", "piece"], ignore_index=True)  # as good as shuffled, and the same in reruns
        sizes = pdf["length"].to_numpy()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, held in enumerate(b for b in search(sizes, next_fit(sizes, length), length).bins if b):
            sequence[held] = (int(pdf.grp.iloc[0]) << 32) + k
            offset[held] = np.cumsum(sizes[held]) - sizes[held]
        return pdf.drop(columns="grp").assign(sequence_id=sequence, offset=offset)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    dealt = some.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    alone = cut.where(F.col("length") == length).select("*", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.groupBy("grp").applyInPandas(packed, kind).unionByName(alone)

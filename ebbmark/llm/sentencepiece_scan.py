"""SentencePiece (BPE) encoding by a max-plus scan, and decoding.

A sequence of pieces is the encoding of its text exactly if every two
neighbours are the encoding of their own concatenation. So encoding is a best
path through the pieces of a text in which a step costs nothing if the pair
stands and minus infinity if it does not.

A giant text is cut into chunks anywhere, in the middle of words too. The state
at a cut is the piece that covers or ends at it. Each chunk yields a transfer
matrix over the states at its two cuts (0 where a path of valid steps exists);
the max-plus products of these, combined as a tree, single out the one state at
every cut that lies on the whole text's path. Then every chunk traces its own
pieces back between its two states, independently of the others.

Between a visible character and a space no piece reaches across, so within a
chunk whole words have pieces of their own, which are looked up once met. The
paths of words not met before are found together, by the thousand, as arrays.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import giving_back, slices, stored, texts_of
from ebbmark.llm.columns import others

# Characters of a chunk; a text of no more is one chunk.
CHUNK = 32_768
# Words, and pairs of pieces, that a worker remembers: about 250 bytes each.
REMEMBERED = 200_000
# Longer words, as texts without spaces have, hardly come again.
LONGEST_REMEMBERED = 32
# A code below this is a single character, one from it on a piece of several.
CODES = 0x110000
CODE_BITS = 21
SPACE = "▁"

_ENCODED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_chunks", T.LongType()), T.StructField("ids", T.BinaryType())]
)
_MATRIX = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("n_in", T.IntegerType()),
        T.StructField("n_out", T.IntegerType()),
        T.StructField("matrix", T.BinaryType()),
    ]
)
_STATES = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("entry", T.IntegerType()),
        T.StructField("exit", T.IntegerType()),
    ]
)
_TRACED = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class Pieces:
    """The vocabulary of a BPE model, and which pieces may stand next to each other."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = model.unk_id()
        self.has_bytes = model.is_byte(self.bytes[0])
        # What each id stands for when decoded.
        self.content: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.content.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.content.append(b"")
            elif model.is_unknown(i):
                self.content.append(" ⁇ ".encode())
            else:
                self.content.append(piece.replace(SPACE, " ").encode())
                if not model.is_unused(i):
                    self.ids[piece] = i
                    self.scores[piece] = model.get_score(i)
        self.longest = max(map(len, self.ids))
        # When a piece's merge is due, and what it was merged from, for pieces that stand for their own text.
        self.due = {piece: -score for piece, score in self.scores.items()}
        self.halves = {piece: parts for piece in self.ids if (parts := self.halves_of(piece))}
        # How long a piece can be that begins with three given characters.
        self.spread: dict[str, int] = {}
        for piece in self.halves:
            if len(piece) > 2:
                self.spread[piece[:3]] = max(len(piece), self.spread.get(piece[:3], 0))
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def halves_of(self, piece: str) -> tuple[str, str] | None:
        """The two parts a piece was last merged from, best score first and leftmost among equals.

        ``None`` for a single character, and for a piece that merging its own
        characters does not lead to.
        """
        parts = list(piece)
        while len(parts) > 2:
            best, place = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, place = score, i
            if best is None:
                return None
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def apart(self, left: str, right: str) -> bool:
        """Whether two pieces side by side stay what they are: the weight 0 of a step.

        The merges on either side of the seam are undone, latest first. In
        between, the two parts that meet at the seam lie side by side until the
        merge undone last; had theirs been due before it, the seam would be gone.
        """
        if right[0] == SPACE and left[-1] != SPACE:
            return True
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._keeps_seam(left, right)
        return known

    def _keeps_seam(self, left: str, right: str) -> bool:
        due, halves = self.due, self.halves
        limit = float("inf")
        while True:
            merge = due.get(left + right)
            if merge is not None and merge < limit:
                return False
            left_due = due[left] if len(left) > 1 else -1
            right_due = due[right] if len(right) > 1 else -1
            if left_due < 0 and right_due < 0:
                return True
            if left_due > right_due:
                limit, left = left_due, halves[left][1]
            else:
                # Of equal merges the left one comes first: here the seam's.
                limit, right = right_due + 0.5, halves[right][0]

    def reach(self, text: str, start: int, end: int, first: str | None) -> list[int]:
        """For each place from ``start`` to ``end`` where the last piece begins, -1 if no path ends there.

        The piece before ``start`` is ``first``. A path, where there is one, is unique.
        """
        halves, apart, pairs, spread = self.halves, self.apart, self.pairs, self.spread
        back = [-1] * (end - start + 1)
        for j in range(start, end):
            if j == start:
                before = first
            elif back[j - start] >= 0:
                before = text[back[j - start] : j]
            else:
                continue
            for i in range(j + 1, min(j + spread.get(text[j : j + 3], 2), end) + 1):
                if back[i - start] >= 0:
                    continue
                piece = text[j:i]
                if i > j + 1 and piece not in halves:
                    continue
                good = before is None or pairs.get((before, piece))
                if good or (good is None and apart(before, piece)):
                    back[i - start] = j
        return back

    def trace(self, text: str, start: int, end: int, back: list[int]) -> list[str]:
        pieces = []
        while end > start:
            begin = back[end - start]
            pieces.append(text[begin:end])
            end = begin
        return pieces[::-1]

    def ids_of(self, pieces: list[str]) -> bytes:
        found = array("I")
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                found.append(known)
            elif self.has_bytes:
                found.extend(self.bytes[b] for b in piece.encode())
            else:
                found.append(self.unknown)
        return found.tobytes()

    @cached_property
    def codes(self) -> Codes:
        return Codes(self)

    def word(self, word: str) -> bytes:
        """Ids of a word: a run of spaces and the visible characters after it."""
        return self.texts([word])[0]

    def text(self, text: str) -> bytes:
        """Ids of a text between two places no piece reaches across."""
        return self.texts([text])[0]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each between two places no piece reaches across."""
        found = [_WORD.findall(text) for text in texts]
        known = self.words
        fresh = set().union(*found).difference(known)
        short = [word for word in fresh if len(word) <= LONGEST_REMEMBERED]
        new = dict(zip(short, self.codes.encoded(short)))
        known.update(islice(new.items(), max(0, REMEMBERED - len(known))))
        for word in fresh:
            if len(word) > LONGEST_REMEMBERED:
                new[word] = self.ids_of(self.trace(word, 0, len(word), self.reach(word, 0, len(word), None)))
        got = ((words, map(known.get, words)) for words in found)
        return [b"".join([new[w] if ids is None else ids for w, ids in zip(words, all_ids)]) for words, all_ids in got]


def _lookup(found: dict[int, float], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, one beyond all others at the end, and their values."""
    keys = np.array([*found, np.iinfo(np.int64).max], np.int64)
    values = np.array([*found.values(), 0], kind)
    order = np.argsort(keys)
    return keys[order], values[order]


class Codes:
    """The pieces of a model as numbers: the best paths of many short words, a place of all of them at a time."""

    def __init__(self, pieces: Pieces):
        longer = {piece: CODES + k for k, piece in enumerate(pieces.halves)}
        halves = [[longer.get(part) or ord(part) for part in pieces.halves[piece]] for piece in longer]
        # By code less CODES - 1, so that all single characters come first: when due, and what merged.
        self.due = np.array([-1, *(pieces.due[piece] for piece in longer)], np.float64)
        self.left = np.array([0, *(left for left, _ in halves)], np.int64)
        self.right = np.array([0, *(right for _, right in halves)], np.int64)
        merges = {}
        for piece, due in pieces.due.items():
            for k in range(1, len(piece)):
                parts = [ord(part) if len(part) == 1 else longer.get(part) for part in (piece[:k], piece[k:])]
                if None not in parts:
                    merges[parts[0] << CODE_BITS | parts[1]] = due
        self.merge_keys, self.merge_due = _lookup(merges, np.float64)
        # The pieces letter by letter: nodes of a trie, and the code of the piece that ends at each.
        steps, ends = {}, [-1]
        for piece, code in longer.items():
            node = 0
            for letter in piece:
                node = steps.setdefault(node << CODE_BITS | ord(letter), len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = code
        self.step_keys, self.step_to = _lookup(steps, np.int64)
        self.first = np.zeros(CODES, np.int32)
        for key, node in steps.items():
            if key < CODES:
                self.first[key] = node
        self.ends = np.array(ends, np.int64)
        self.ids = np.full(CODES + len(longer), -1, np.int32)
        for piece, number in pieces.ids.items():
            if len(piece) == 1 or piece in longer:
                self.ids[longer.get(piece) or ord(piece)] = number
        self.spelled = pieces.bytes if pieces.has_bytes else None
        self.unknown = pieces.unknown

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Pieces._keeps_seam`` of many pairs of codes."""
        good = np.zeros(len(left), bool)
        which, limit = np.arange(len(left)), np.full(len(left), np.inf)
        while len(which):
            key = left << CODE_BITS | right
            at = np.searchsorted(self.merge_keys, key)
            gone = (self.merge_keys[at] == key) & (self.merge_due[at] < limit)
            x, y = np.maximum(left - (CODES - 1), 0), np.maximum(right - (CODES - 1), 0)
            left_due, right_due = self.due[x], self.due[y]
            done = (left_due < 0) & (right_due < 0)
            good[which[done & ~gone]] = True
            # Of equal merges the left one comes first: here the seam's.
            undo_left = left_due > right_due
            limit = np.where(undo_left, left_due, right_due + 0.5)
            left, right = np.where(undo_left, self.right[x], left), np.where(undo_left, right, self.left[y])
            more = ~(gone | done)
            which, left, right, limit = which[more], left[more], right[more], limit[more]
        return good

    def _matches(self, chars: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pieces begin, their lengths and codes; ``room`` characters are left from each place on."""
        begins, lengths, codes = [np.arange(len(chars))], [np.ones(len(chars), np.int64)], [chars]
        node, length = self.first[chars].astype(np.int64), 1
        at = np.flatnonzero((node > 0) & (room > 1))
        node = node[at]
        while len(at):
            key = node << CODE_BITS | chars[at + length]
            step = np.searchsorted(self.step_keys, key)
            there = self.step_keys[step] == key
            at, node, length = at[there], self.step_to[step[there]], length + 1
            whole = self.ends[node] >= 0
            begins.append(at[whole])
            lengths.append(np.full(len(begins[-1]), length))
            codes.append(self.ends[node[whole]])
            more = room[at] > length
            at, node = at[more], node[more]
        return np.concatenate(begins), np.concatenate(lengths), np.concatenate(codes)

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words, none of them empty."""
        if not words:
            return []
        sizes = np.array([*map(len, words)], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(words)), sizes)
        heads = np.cumsum(sizes) - sizes
        place = np.arange(len(chars)) - heads[row]
        begins, lengths, codes = self._matches(chars, sizes[row] - place)
        order = np.argsort(place[begins], kind="stable")
        begins, lengths, codes = begins[order], lengths[order], codes[order]
        cuts = np.searchsorted(place[begins], np.arange(int(sizes.max()) + 1))

        # A word of n characters has n + 1 places; of each, the piece that a path ends with there.
        starts = begins + row[begins]
        last, back = np.full(len(chars) + len(words), -1, np.int64), np.ones(len(chars) + len(words), np.int64)
        for k in range(len(cuts) - 1):
            start, length, code = (x[cuts[k] : cuts[k + 1]] for x in (starts, lengths, codes))
            if k:
                open_ = np.flatnonzero((last[start] >= 0) & (last[start + length] < 0))
                open_ = open_[self.apart(last[start[open_]], code[open_])]
                start, length, code = start[open_], length[open_], code[open_]
            last[start + length], back[start + length] = code, length

        first = heads + np.arange(len(words))
        ends = first + sizes
        on_path = np.zeros(len(last), bool)
        now = ends
        while len(now):
            on_path[now] = True
            now = now - back[now]
            now, first = now[now > first], first[now > first]
        path = np.flatnonzero(on_path)
        ids, counts = self._ids_of(last[path])
        per_word = np.bincount(np.searchsorted(ends, path), counts, len(words)).astype(np.int64)
        cuts = [0, *(4 * np.cumsum(per_word)).tolist()]
        whole = ids.astype("<u4").tobytes()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has: characters without one are spelled in bytes or unknown."""
        ids, counts = self.ids[codes], np.ones(len(codes), np.int64)
        odd = np.flatnonzero(ids < 0)
        spelled = [[self.unknown] if self.spelled is None else [self.spelled[b] for b in chr(c).encode()] for c in codes[odd].tolist()]
        counts[odd] = [*map(len, spelled)]
        ids = np.repeat(ids, counts)
        ids[ids < 0] = [i for found in spelled for i in found]
        return ids, counts


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


class Chunk:
    """A chunk with its surroundings, whose cuts have states and a transfer between them."""

    def __init__(self, pieces: Pieces, before: str, body: str, after: str, first: bool, last: bool):
        self.pieces = pieces
        self.text = before + body + after
        self.start, self.end = len(before), len(before) + len(body)
        self.entries = [(0, 0)] if first else self._states(self.start)
        self.exits = [(self.end, self.end)] if last else self._states(self.end)
        text, reach = self.text, pieces.longest
        cuts = (p for p in range(self.start + reach, self.end - reach) if text[p] == SPACE and text[p - 1] != SPACE)
        self.first_cut = next(cuts, None)
        self.last_cut = None
        if self.first_cut is not None:
            p = self.end - reach - 1
            while not (text[p] == SPACE and text[p - 1] != SPACE):
                p -= 1
            self.last_cut = p

    def _states(self, cut: int) -> list[tuple[int, int]]:
        """Pieces that begin before a cut and end at it or after, in order."""
        longest = self.pieces.longest
        return [
            (j, e)
            for j in range(max(0, cut - longest), cut)
            for e in range(cut, min(len(self.text), j + longest) + 1)
            if e == j + 1 or self.text[j:e] in self.pieces.halves
        ]

    def _forward(self, entry: tuple[int, int], until: int) -> list[int]:
        begin, start = entry
        return self.pieces.reach(self.text, start, until, self.text[begin:start] or None)

    def _open_exits(self, start: int, back: list[int], first: str | None) -> list[bool]:
        found = []
        for begin, end in self.exits:
            if begin == end:
                found.append(back[begin - start] >= 0 or begin == start)
            elif begin == start:
                found.append(first is None or self.pieces.apart(first, self.text[begin:end]))
            else:
                last = back[begin - start] if start <= begin else -1
                found.append(last >= 0 and self.pieces.apart(self.text[last:begin], self.text[begin:end]))
        return found

    def transfer(self) -> np.ndarray:
        """0 where a valid path leads from an entry state to an exit state, else minus infinity."""
        if self.first_cut is None:
            good = [
                self._open_exits(e[1], self._forward(e, self.end), self.text[e[0] : e[1]] or None) for e in self.entries
            ]
        else:
            arrives = [self._forward(e, self.first_cut)[-1] >= 0 for e in self.entries]
            leaves = self._open_exits(self.last_cut, self.pieces.reach(self.text, self.last_cut, self.end, None), None)
            good = np.outer(arrives, leaves)
        return np.where(np.array(good, bool).reshape(len(self.entries), len(self.exits)), 0.0, -np.inf).astype(np.float32)

    def backtrace(self, entry: int, exit: int) -> bytes:
        """Ids of the pieces after the entry state up to and with the exit state."""
        head, middle, tail = self.ends(entry, exit)
        return head + self.pieces.text(middle) + tail

    def ends(self, entry: int, exit: int) -> tuple[bytes, str, bytes]:
        """``backtrace`` with the whole words in between left as text."""
        start, (begin, end) = self.entries[entry][1], self.exits[exit]
        crossing = [self.text[begin:end]] if end > begin else []
        if self.first_cut is None:
            back = self._forward(self.entries[entry], begin)
            return self.pieces.ids_of(self.pieces.trace(self.text, start, begin, back) + crossing), "", b""
        head = self.pieces.trace(self.text, start, self.first_cut, self._forward(self.entries[entry], self.first_cut))
        tail = self.pieces.trace(
            self.text, self.last_cut, begin, self.pieces.reach(self.text, self.last_cut, begin, None)
        )
        return self.pieces.ids_of(head), self.text[self.first_cut : self.last_cut], self.pieces.ids_of(tail + crossing)


def max_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left[:, :, None] + right[None, :, :]).max(1)


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """The state of the best path at every cut, the two ends included.

    Products of neighbours are taken pairwise up a tree; on the way down each
    node, its outer states known, settles the state in its middle.
    """
    levels = [matrices]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([max_plus(*below[i : i + 2]) if i + 1 < len(below) else below[i] for i in range(0, len(below), 2)])
    states = [0, 0]
    for above, below in zip(levels[:0:-1], levels[-2::-1]):
        settled = [states[0]]
        for i in range(len(above)):
            if 2 * i + 1 < len(below):
                paths = below[2 * i][settled[-1], :] + below[2 * i + 1][:, states[i + 1]]
                settled.append(int(paths.argmax()))
            settled.append(states[i + 1])
        states = settled
    return states


def _as_pieces(text: str) -> str:
    return text.replace(" ", SPACE)


def encode(docs: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_chunks, ids)``, one row for every row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit numbers, those of the library's
    own encoder for a model without normalization. A null or empty text has
    none, in one chunk. Repeated rows are encoded one by one, a null id stays
    null; columns besides ``doc_id`` and ``text`` are ignored; an empty table
    gives no rows.
    """
    if chunk < 64:
        raise ValueError("chunks must be longer than pieces are")
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    reach = _pieces(model_path).longest

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in slices(texts):
                ids = pieces.texts([SPACE + _as_pieces(t) if t else "" for t in texts[first:last].to_pylist()])
                ones = pa.array([1] * len(ids), pa.int64())
                columns = [batch.column(0)[first:last], ones, pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=_ENCODED.names)

    def chunks_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, Chunk]]:
        pieces = _pieces(model_path)
        for row in batch.to_pylist():
            first, last = row["chunk"] == 0, row["chunk"] == row["n_chunks"] - 1
            before, body, after = (_as_pieces(row[k]) for k in ("before", "body", "after"))
            # The space that every text begins with lies in the first chunk, and in what the second sees of it.
            yield row, Chunk(pieces, before, SPACE + body if first else body, after, first, last)

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, part in chunks_of(batch):
                matrix = part.transfer()
                rows.append((row["row"], row["chunk"], *matrix.shape, matrix.tobytes()))
            yield _batch(rows, _MATRIX)

    def scanned(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("chunk")
        matrices = [
            np.frombuffer(m, np.float32).reshape(a, b) for a, b, m in zip(found.n_in, found.n_out, found.matrix)
        ]
        states = cut_states(matrices)
        return pd.DataFrame({"row": found.row, "chunk": found.chunk, "entry": states[:-1], "exit": states[1:]})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in batches:
            for first, last in slices(texts_of(batch.column("body"))):
                parts = [(row, *part.ends(row["entry"], row["exit"])) for row, part in chunks_of(batch.slice(first, last - first))]
                middles = pieces.texts([middle for _, _, middle, _ in parts])
                rows = [(row["row"], row["doc_id"], row["chunk"], a + b + c) for (row, a, _, c), b in zip(parts, middles)]
                yield _batch(rows, _TRACED)

    small = texts.filter(F.char_length("text") <= chunk).mapInArrow(giving_back(whole), _ENCODED)
    giant = texts.filter(F.char_length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    giant = giant.withColumn("n_chunks", F.expr(f"(char_length(text) + {chunk} - 1) div {chunk}"))
    cut = giant.select("*", F.explode(F.expr("sequence(0L, n_chunks - 1)")).alias("chunk"))
    cut = cut.select(
        "row",
        "doc_id",
        "n_chunks",
        "chunk",
        F.expr(f"IF(chunk = 0, '', substring(text, CAST(chunk * {chunk} - {reach} + 1 AS INT), {reach}))").alias("before"),
        F.expr(f"substring(text, CAST(chunk * {chunk} + 1 AS INT), {chunk})").alias("body"),
        F.expr(f"substring(text, CAST((chunk + 1) * {chunk} + 1 AS INT), {reach})").alias("after"),
    )
    cut = stored(cut, spark, "chunks")
    # A text's matrices come together: a few hundred bytes for every chunk of it.
    states = cut.mapInArrow(giving_back(transfers), _MATRIX).groupBy("row").applyInPandas(scanned, _STATES)
    found = cut.join(states, ["row", "chunk"]).mapInArrow(giving_back(traced), _TRACED)
    together = found.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    big = together.select(
        "doc_id",
        F.size("parts").cast("bigint").alias("n_chunks"),
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"),
    )
    return small.unionAll(big)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "integer": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    arrays = [pa.array([r[k] for r in rows], kinds[f.dataType.typeName()]) for k, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``text``, the texts of its ``ids`` without the space a text begins with.

    Null or empty ``ids`` are an empty text; bytes that are no UTF-8 become
    U+FFFD. A column named ``text``, in any case, is replaced, others stay.
    """
    rows = encoded.select(*others(encoded, ["text"]))
    place = rows.columns.index("ids")
    out = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = _pieces(model_path).content
        for batch in batches:
            held = pc.fill_null(batch.column(place), b"")
            for first, last in slices(held):
                texts = []
                for ids in held[first:last].to_pylist():
                    found = b"".join([content[i] for i in np.frombuffer(ids, "<u4").tolist()])
                    texts.append(found.removeprefix(b" ").decode("utf-8", "replace"))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=out.names)

    return rows.mapInArrow(giving_back(decoded), out)

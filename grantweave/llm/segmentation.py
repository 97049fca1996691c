"""SentencePiece encoding with the N best segmentations, and decoding.

A text is a lattice of pieces. The forward Viterbi pass gives the best score from the start to each position;
backward A-star search from the end uses these scores as its heuristic, which is exact, so complete
paths leave the queue in order of their total score. Pieces do not cross from a word to the space mark after
it, nor over a line break, so the lattice is cut there, and the N best of a text are merged from those of its words.

Few words of a text can matter beyond their best path: the N - 1 whose second path loses least. So a word's
edges are listed once by an automaton of all pieces, and a forward and a backward pass give its best path and what the
second one loses, as a path other than the best has an edge that the best has not. A-star runs for the words that
can matter in some text. Words are remembered by the worker process.

Scores are the model's; a character that no piece covers is spelled in the model's byte pieces at a score
below all others. A space mark that the text itself holds is spelled in bytes too, so decoding returns
every text exactly.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "\u2581"
#: stands for a space mark of the text itself while it is cut; half a pair, so never part of a text
OWN = "\ud800"
N_BEST = 3
#: most words a worker remembers, and the longest that it does
MEMORY = 1_000_000
LONG_WORD = 48
#: how far a byte piece is below the lowest score of a single character
UNKNOWN = 10.0

Path = tuple[float, tuple[int, ...]]
#: the best score of a word, what its second path loses, and the ids of the best path as 32-bit integers
Word = tuple[float, float, bytes]


class Pieces:
    """The pieces of a model, and the best segmentations of texts."""

    def __init__(self, model_path: str | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path or public_tokenizers.path("piece_bpe_32k.model"))
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.text = {i: piece for piece, (i, _) in self.ids.items()}
        self.bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in range(model.get_piece_size()) if model.is_byte(i)}
        self.value = {i: b for b, i in self.bytes.items()}
        self.longest = max(map(len, self.ids))
        self.low = min(score for piece, (_, score) in self.ids.items() if len(piece) == 1) - UNKNOWN
        self._known: dict[str, Word] = {}
        self._searched: dict[tuple[str, int], list[Path]] = {}
        #: words with a path that does not spell them; there should be none
        self.misspelled: set[str] = set()
        self._singles = {piece for piece in self.ids if len(piece) == 1}
        # No piece holds these, so the lattice is cut on both sides of them.
        inside = set("".join(self.ids))
        apart = "".join(c for c in "\n\r\t\v\f" if c not in inside)
        self._chunk = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|[{apart}]" if apart else ""))
        self._automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.ids.items():
            self._automaton.add_word(piece, (len(piece), i, score))
        self._automaton.make_automaton()

    def lattice(self, word: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each position the pieces that end there: start, ids and score."""
        ending: list[list] = [[] for _ in range(len(word) + 1)]
        for i, char in enumerate(word):
            covered = False
            for j in range(i + 1, min(i + self.longest, len(word)) + 1):
                found = self.ids.get(word[i:j])
                if found:
                    covered = covered or j == i + 1
                    ending[j].append((i, (found[0],), found[1]))
            if not covered:
                raw = (MARK if char == OWN else char).encode("utf-8", "surrogatepass")
                ending[i + 1].append((i, tuple(self.bytes[b] for b in raw), self.low * len(raw)))
        return ending

    def best(self, word: str, n: int) -> list[Path]:
        """The ``n`` best paths through a word's lattice, best first; equal scores by their order in the lattice.

        A queue entry points to the piece behind it, so all paths share their ends. No position is taken more than
        ``n`` times: a later path through it is not better than the ``n`` before. Both are linear in the word.
        """
        ending = self.lattice(word)
        forward = [0.0] + [float("-inf")] * len(word)
        for j in range(1, len(word) + 1):
            forward[j] = max((forward[i] + score for i, _, score in ending[j]), default=float("-inf"))
        taken = [0] * (len(word) + 1)
        serial = 0
        queue: list[tuple] = [(-forward[-1], len(word), serial, 0.0, None)]
        found: list[Path] = []
        while queue and len(found) < n:
            _, j, _, behind, link = heapq.heappop(queue)
            if not j:
                ids: list[int] = []
                while link:
                    piece, link = link
                    ids += piece
                found.append((behind, tuple(ids)))
                continue
            if taken[j] == n:
                continue
            taken[j] += 1
            for i, piece, score in ending[j]:
                serial += 1
                heapq.heappush(queue, (-(forward[i] + score + behind), i, serial, score + behind, (piece, link)))
        return found

    def viterbi(self, word: str) -> Word:
        """The best path of a word and the loss of its second."""
        if not self._singles.issuperset(word):
            paths = self.best(word, 2)
            self._check(paths[0][1], word)
            return paths[0][0], paths[0][0] - paths[1][0] if len(paths) > 1 else math.inf, _raw(paths[0][1])
        n = len(word)
        forward = [0.0] + [-math.inf] * n
        behind = [-math.inf] * n + [0.0]
        back = [(0, 0)] * (n + 1)
        edges = list(self._automaton.iter(word))
        for last, (size, piece, score) in edges:
            total = forward[last - size + 1] + score
            if total > forward[last + 1]:
                forward[last + 1] = total
                back[last + 1] = size, piece
        ids, at = [], n
        while at:
            size, piece = back[at]
            ids.append(piece)
            at -= size
            back[at + size] = -size, piece  # an edge of the best path
        ids.reverse()
        self._check(ids, word)
        second = -math.inf
        # Edges come by their ends, so backwards all that start at an edge's end have been seen.
        for last, (size, piece, score) in reversed(edges):
            total = score + behind[last + 1]
            begin = last - size + 1
            if total > behind[begin]:
                behind[begin] = total
            total += forward[begin]
            if total > second and back[last + 1] != (-size, piece):
                second = total
        return forward[n], forward[n] - second, _raw(ids)

    def _check(self, ids: list[int] | tuple[int, ...], word: str) -> None:
        if not self._spells(ids, word):
            self.misspelled.add(word)

    def _look(self, word: str) -> Word:
        found = self.viterbi(word)
        if len(word) <= LONG_WORD:
            if len(self._known) >= MEMORY:
                self._known.clear()
            self._known[word] = found
        return found

    def _search(self, word: str, n: int, first: bytes) -> list[Path]:
        """The ``n`` best paths of a word, ``first`` before others of its score."""
        paths = self._searched.get((word, n))
        if paths is None:
            start = tuple(np.frombuffer(first, "<u4").tolist())
            found = self.best(word, n)
            paths = [(found[0][0], start), *(p for p in found if p[1] != start)][:n]
            for _, ids in paths:
                self._check(ids, word)
            if len(word) <= LONG_WORD:
                if len(self._searched) >= MEMORY // 4:
                    self._searched.clear()
                self._searched[word, n] = paths
        return paths

    def _spells(self, ids: list[int] | tuple[int, ...], word: str) -> bool:
        try:
            return "".join([self.text[i] for i in ids]) == word
        except KeyError:  # a byte piece
            return self.decode(tuple(ids), whole=True) == word.replace(MARK, " ").replace(OWN, MARK)

    def ranked(self, text: str, n: int = N_BEST) -> tuple[list[tuple[float, bytes]], bool]:
        """The ``n`` best segmentations of a text: score and ids as 32-bit integers; and whether they spell it."""
        if not text:
            return [(0.0, b"")], True
        words = self._chunk.findall(MARK + text.replace(MARK, OWN).replace(" ", MARK))
        known = self._known.get
        entries = [known(w) or self._look(w) for w in words]
        total = sum([e[0] for e in entries])
        ids = [e[2] for e in entries]
        exact = not self.misspelled or self.misspelled.isdisjoint(words)
        picked = sorted(at for loss, at in heapq.nsmallest(n - 1, zip([e[1] for e in entries], count())) if loss < math.inf)
        parts = [self._search(words[at], n, ids[at]) for at in picked]
        out = []
        for cost, taken in choices(parts, n):
            own = ids.copy() if taken else ids
            for part, rank in taken.items():
                own[picked[part]] = _raw(parts[part][rank][1])
            out.append((total - cost, b"".join(own)))
        return out, exact and self.misspelled.isdisjoint(words[at] for at in picked)

    def encode(self, text: str, n: int = N_BEST) -> list[Path]:
        """The ``n`` best segmentations of a text: score and ids."""
        return [(score, tuple(np.frombuffer(raw, "<u4").tolist())) for score, raw in self.ranked(text, n)[0]]

    def decode(self, ids: tuple[int, ...], whole: bool = False) -> str:
        """The text of a sequence of ids, without the space mark that begins it unless it is wanted ``whole``."""
        out = bytearray()
        for i in ids:
            piece = self.text.get(i)
            out += bytes([self.value[i]]) if piece is None else piece.replace(MARK, " ").encode("utf-8", "surrogatepass")
        text = out.decode("utf-8", "surrogatepass")
        return text[1:] if ids and not whole else text


def _raw(ids: list[int] | tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def pieces_of(model_path: str | None) -> Pieces:
    """One for all tasks of a worker process."""
    return Pieces(model_path)


def choices(parts: list[list[Path]], n: int) -> list[tuple[float, dict[int, int]]]:
    """The ``n`` best ways to take one path of each part: the loss, and the ranks of parts that do not take their best.

    Only parts whose second path costs little can matter: of each rank below the first, the ``n - 1`` parts that
    lose least by it. Their combinations are few. Equal losses are ordered by choice, first parts first.
    """
    losses: list[tuple[float, int, int]] = []
    for rank in range(1, n):
        there = [(p[0][0] - p[rank][0], at, rank) for at, p in enumerate(parts) if len(p) > rank]
        losses += heapq.nsmallest(n - 1, there)
    found: list[tuple[float, dict[int, int]]] = [(0.0, {})]
    for at in sorted({at for _, at, _ in losses}):
        own = [(loss, rank) for loss, where, rank in losses if where == at]
        wider = found + [(cost + loss, {**taken, at: rank}) for cost, taken in found for loss, rank in own]
        found = sorted(wider, key=lambda c: (c[0], sorted(c[1].items())))[:n]
    return found


def merged(parts: list[list[Path]], n: int) -> list[Path]:
    """The ``n`` best ways to take one path of each part, best first."""
    base = sum(p[0][0] for p in parts)
    return [
        (base - cost, tuple(i for at, p in enumerate(parts) for i in p[taken.get(at, 0)][1]))
        for cost, taken in choices(parts, n)
    ]


def segmented(
    rows: DataFrame, keys: list[str], text_column: str = "text", n: int = N_BEST, model_path: str | None = None
) -> DataFrame:
    """Of every row the ``n`` best segmentations: the key columns, ``rank`` from 1, ``score``, ``n_pieces``,
    ``ids_crc32`` of the little-endian 32-bit ids, and ``exact``, whether they decode to the text.

    A text has fewer rows if it has fewer segmentations. Null and empty texts have one, without pieces. Repeated
    rows are encoded each for itself, an empty table gives no rows, and other columns are not read.
    """
    schema = T.StructType(
        [rows.schema[k] for k in keys]
        + [
            T.StructField("rank", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_pieces", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("exact", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        for batch in batches:
            at, values = [], []
            for i, text in enumerate(batch.column(len(keys))):
                text = text.as_py() or ""
                found, exact = pieces.ranked(text, n)
                for rank, (score, raw) in enumerate(found, 1):
                    at.append(i)
                    values.append((rank, score, len(raw) // 4, zlib.crc32(raw), exact))
            taken = pa.array(at, pa.int64())
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_())
            columns = list(zip(*values)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(taken) for k in range(len(keys))), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                schema.names,
            )

    return rows.select(*keys, F.col(text_column).cast("string")).mapInArrow(run, schema)

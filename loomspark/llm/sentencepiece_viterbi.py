"""SentencePiece encoding and decoding by a streaming Viterbi search.

The trellis has a node at each character boundary and an edge for each piece. Only starts from which
some piece can still reach past the current character stay alive, at most the longest piece back; ids
are committed as soon as the back pointers of all live paths meet at one boundary, so the window stays
within a few piece lengths whatever the length of the text.

* ``unigram`` models: the path of the highest score.
* ``bpe`` models (the public file is one): merge ranks are not additive scores, so the best path is the
  one whose neighbouring pieces all stand side by side when the two are merged alone: exactly one
  piece can end the merged form of each prefix, and the search finds it with the same window and back
  pointers. Results equal the library's.

White space is written as the mark U+2581, one is put before a text that is not empty, and a character
without a piece becomes its UTF-8 bytes where the model has byte pieces, else the unknown id. Where no
piece can cross (before a mark that follows another character) all paths converge; what the search
commits between two such places is kept in a bounded cache, if it is short.

Null or empty texts give an empty list of ids and decode to the empty string; decoding turns a literal
U+2581 into a space, as the library does. Repeated rows are encoded one by one, and an empty table gives
an empty table. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import bounded_batches, free_name, table, text_or_empty, tokenizer_path, without

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Kinds of piece in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PAIRS, WORDS, LONGEST_WORD = 1 << 18, 1 << 19, 48


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


class Window:
    """The boundaries since the last commit. Of each: where the best piece that ends there begins, its id (or minus two
    less the character of a fallback), for unigram models the path's score, and the starts, with their places in the
    tree, from which some piece can carry on."""

    def __init__(self) -> None:
        self.begin, self.last, self.score, self.lives = [-1], [-1], [0.0], [[]]
        self.text: str | None = ""  # what was searched; None once ids of it were committed

    def commit(self, at: int) -> None:
        """Forgets what lies before the boundary at. The lists stay the same objects."""
        self.text = None
        self.lives[:] = [[(i - at, node) for i, node in self.lives[-1]]]
        self.score[:] = [x - self.score[at] for x in self.score[at:]]
        self.begin[:] = [-1, *(i - at for i in self.begin[at + 1 :])]
        del self.last[:at]

    def rewind(self, text: str) -> int:
        """Back to the last boundary that text shares with what was searched; how many characters that are."""
        same = 0
        if self.text is None:
            self.__init__()
        else:
            for a, b in zip(self.text, text):
                if a != b:
                    break
                same += 1
            for own in (self.begin, self.last, self.score, self.lives):
                del own[same + 1 :]
        self.text = text
        return same


class Vocabulary:
    """Pieces with scores and kinds; keeps the search's caches, one instance for each worker."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = UNIGRAM, dummy_prefix: bool = True):
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self.pieces = [p for p, _, _ in pieces]
        self.scores = [s for _, s, _ in pieces]
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN), 0)
        self.tree: dict = {}  # children by character; under None the id of the piece that ends here
        for p, i in self.ids.items():
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[None] = i
        self.longest = max(map(len, self.ids), default=1)
        self.low = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.raw = [bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else p.encode() if k != UNKNOWN else " ⁇ ".encode() for p, _, k in pieces]
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, tuple[list[float], list[str], list[str]]] = {}
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        whole = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.runs = re.compile(f"[{alone or chr(0)}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+") if whole else None
        self.words: dict[str, bytes] = {}  # ids of runs that no piece can cross
        self.bpe, self.scale = kind == BPE, len(pieces)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            data = f.read()
        pieces, kind, dummy = [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                x = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                pieces.append((x[1].decode(), struct.unpack("<f", x[2])[0], x[3]))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                dummy = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("only models that leave characters and white space as they are")
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"no search for model type {kind}")
        return cls(pieces, kind, dummy)

    def history(self, piece: int) -> tuple[list[float], list[str], list[str]]:
        """How the piece's characters merge, best neighbours first, leftmost of equals: the scores in order, and
        before and after each merge the part at the left and at the right end."""
        found = self.histories.get(piece)
        if found is None:
            parts = list(self.pieces[piece])
            scores, left, right = [], [parts[0]], [parts[-1]]
            while True:
                best, at = None, 0
                for i in range(len(parts) - 1):
                    joined = self.ids.get(parts[i] + parts[i + 1])
                    if joined is not None and (best is None or self.scores[joined] > best):
                        best, at = self.scores[joined], i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                scores.append(best)
                left.append(parts[0])
                right.append(parts[-1])
            if len(parts) > 1:  # it never comes about by merging
                scores, left, right = [], [], []
            found = self.histories[piece] = (scores, left, right)
        return found

    def side_by_side(self, left: int, right: int) -> bool:
        """Would the characters of both pieces merge to just these two? Both merge on their own, whichever has the
        better merge first, unless a merge across their border is better than either."""
        key = left * self.scale + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            (sa, _, ends), (sb, begins, _) = self.history(left), self.history(right)
            i = j = 0
            found = bool(ends) and bool(begins)
            while found:
                a, b = sa[i] if i < len(sa) else None, sb[j] if j < len(sb) else None
                across = self.ids.get(ends[i] + begins[j])
                if across is not None and (a is None or self.scores[across] > a) and (b is None or self.scores[across] >= b):
                    found = False
                elif a is None and b is None:
                    break
                elif b is None or (a is not None and a >= b):
                    i += 1
                else:
                    j += 1
            self.pairs[key] = found
        return found

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def search(self, text: Iterable[str], kept: Window | None = None) -> Iterator[list[int]]:
        """Ids of the marked text, in lists, each as soon as all live paths agree on it.

        kept: the window of the run searched before. What this run (then a str) begins with alike isn't searched again;
        its ids are then committed where the run ends, or where the window is full.
        """
        w = kept or Window()
        if kept:
            text = text[w.rewind(text) :]
        score, begin, last, lives = w.score, w.begin, w.last, w.lives
        top, most, scores, scale, pairs, bpe = self.tree, 4 * self.longest, self.scores, self.scale, self.pairs, self.bpe
        for char in text:
            end, start, best, gain = len(begin), -1, -1, 0.0
            alive = []
            for at, node in (*lives[-1], (end - 1, top)):
                node = node.get(char)
                if node is None:
                    continue
                piece = node.get(None)
                if piece is None:
                    alive.append((at, node))
                    continue
                if not bpe:
                    if start < 0 or score[at] + scores[piece] > gain:
                        start, best, gain = at, piece, score[at] + scores[piece]
                elif start < 0:
                    before = last[at]
                    fits = before < 0 or pairs.get(before * scale + piece)
                    if fits or (fits is None and self.side_by_side(before, piece)):
                        start, best = at, piece
                if len(node) > 1:
                    alive.append((at, node))
            if start < 0 or (not bpe and char not in self.ids and score[-1] + self.low > gain):
                start, best, gain = end - 1, -2 - ord(char), score[-1] + self.low
            begin.append(start)
            last.append(best)
            score.append(gain)
            lives.append(alive)
            if end >= most or not (alive or kept):
                at = self._meet(begin, [*(x[0] for x in alive), end])
                if at:
                    yield self._path(begin, last, at)
                    w.commit(at)
        if len(begin) > 1:
            yield self._path(begin, last, len(begin) - 1)

    @staticmethod
    def _meet(begin: list[int], live: list[int]) -> int:
        """The last boundary that the paths to all live boundaries share."""
        heads = set(live)
        while len(heads) > 1:
            top = max(heads)
            heads.remove(top)
            heads.add(begin[top])
        return heads.pop()

    def _path(self, begin: list[int], last: list[int], at: int) -> list[int]:
        out: list[int] = []
        while at > 0:
            piece = last[at]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(reversed(self.fallback(chr(-2 - piece))))
            at = begin[at]
        out.reverse()
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers in the machine's order."""
        marked = [(MARK if self.dummy_prefix else "") + t.replace(" ", MARK) if t else "" for t in texts]
        if self.runs is None:
            return [b"".join(array("i", ids).tobytes() for ids in self.search(t)) for t in marked]
        split = [self.runs.findall(t) for t in marked]
        new = set()
        for words in split:
            new.update(words)
        new.difference_update(self.words)
        if len(self.words) + len(new) > WORDS:
            self.words.clear()
            new = {w for words in split for w in words}
        window = Window()
        for w in sorted(new):
            self.words[w] = array("i", chain.from_iterable(self.search(w, window))).tobytes()
        out = [b"".join(map(self.words.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > LONGEST_WORD:
                del self.words[w]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary.load(path)
    return _LOADED[path]


def _slices(batches: Iterator[pa.Array], rows: int = 512) -> Iterator[pa.Array]:
    """Small parts of large batches, so that ids of a few rows only are held."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """df with out_col: the ids of each whole text."""

    bounded_batches(df.sparkSession)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = vocabulary(path)
        for batch in _slices(batches):
            yield _id_lists(model.encode_all(batch.to_pylist()))
        model.words.clear()  # the worker may serve other stages next

    kept = without(df, out_col) if text_col.lower() != out_col.lower() else df
    return kept.withColumn(out_col, ids_of(text_or_empty(text_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """df with out_col: the text of each list of ids; null for a null list."""

    bounded_batches(df.sparkSession)

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = vocabulary(path)
        for batch in _slices(batches):
            yield pa.array([model.decode(x.as_py()) if x.is_valid else None for x in batch], pa.string())

    kept = without(df, out_col) if ids_col.lower() != out_col.lower() else df
    return kept.withColumn(out_col, text_of(F.col(ids_col)))


def encode_and_decode(df: DataFrame, path: str, text_col: str = "text", *, ids_col: str = "ids", digest_col: str = "decoded_sha256", same_col: str = "round_trip") -> DataFrame:
    """encode, and in the same worker decode: the ids, the digest of the decoded text, and whether it is the
    text (its own U+2581 read as spaces)."""
    bounded_batches(df.sparkSession)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("digest", pa.string()), ("same", pa.bool_())])

    @F.arrow_udf("struct<ids:array<int>,digest:string,same:boolean>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = vocabulary(path)
        for batch in _slices(batches):
            texts = batch.to_pylist()
            ids, digests, same = model.encode_all(texts), [], []
            for text, own in zip(texts, ids):
                decoded = model.decode(array("i", own))
                digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                same.append(decoded == text.replace(MARK, " "))
            yield pa.StructArray.from_arrays([_id_lists(ids), pa.array(digests, pa.string()), pa.array(same, pa.bool_())], fields=list(kind))
        model.words.clear()

    kept = without(df, ids_col, digest_col, same_col)
    names = [F.col(f"`{c}`") for c in kept.columns]
    own = free_name(df.columns, "coded__")
    done = df.select(*names, coded(text_or_empty(text_col)).alias(own))
    return done.select(*names, F.col(f"{own}.ids").alias(ids_col), F.col(f"{own}.digest").alias(digest_col), F.col(f"{own}.same").alias(same_col))


def op10_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_and_decode(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "decoded_sha256", "round_trip")

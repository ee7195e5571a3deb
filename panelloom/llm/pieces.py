"""SentencePiece encoding and decoding by a shared-prefix forward pass over a trie of marked words.

White space becomes a mark before the word, and no piece holds a mark behind another character, so a
text splits into marked words that are encoded one by one. The distinct words of a batch are sorted, so
that words with a common start are neighbours: walking them in this order is a depth-first traversal of
their trie, and the forward states of the common start are kept on a stack and used again.

For a unigram model a state is the Viterbi score of a prefix, with the best last piece. For a BPE model
the best segmentation is not the one with the highest sum of scores but the one that its merges give;
there, too, each prefix has exactly one last piece: the piece that ends there and that no merge joins
with the last piece of the rest. So one forward pass over prefixes gives the merges' result.

Defined cases: a null or empty text has no ids; characters without a piece become bytes where the model
has byte pieces, else the unknown id; a mark in the text itself reads as a space; texts are encoded
whole; repeated rows are encoded one by one.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids_of_words, keep_warm, lean, portions

MARK = "▁"
_BARE = "\ud800"  # no text holds a lone surrogate
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
#: Words whose ids a Python worker remembers between batches, and pairs of pieces.
CACHE_WORDS, CACHE_PAIRS = 300_000, 250_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces and scores of a model file, with the forward pass. One per Python worker."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is, with marks before words")
        self.bpe = proto.trainer_spec.model_type == 2
        self.dummy_prefix = norm.add_dummy_prefix
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        texts: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type in (_NORMAL, _USER):
                self.score[p.piece], self.ids[p.piece] = p.score, i
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError("a piece holds a mark behind another character")
            elif p.type == _BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
            elif p.type == _UNKNOWN:
                self.unknown = i
            texts.append(bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else b"" if p.type == _CONTROL else " ⁇ ".encode() if p.type == _UNKNOWN else p.piece.replace(MARK, " ").encode())
        self.texts = texts
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.endings: dict = {}  # trie of the pieces from their last character to the first; "" ends one
        for p in self.ids:
            node = self.endings
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = {}
        self.missing = min(self.score.values(), default=0.0) - 10.0
        self.compatible: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.plain = self.dummy_prefix and not any("\n" in p for p in self.ids)  # line breaks part words
        self.words = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if self.plain else f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def _unknown_ids(self, char: str) -> bytes:
        own = char.encode("utf-8", "surrogatepass")
        ids = [self.bytes[b] for b in own] if self.bytes else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by its merges, best score first and leftmost among equals."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = (s, i)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def stands(self, pair: tuple[str, str]) -> bool:
        """Whether no merge joins parts of two neighbouring pieces; with none on the left, whether merges make the piece."""
        if len(self.compatible) >= CACHE_PAIRS:
            for old in list(islice(self.compatible, CACHE_PAIRS // 2, None)):  # early pairs are the frequent ones
                del self.compatible[old]
        known = self.compatible[pair] = self.merge(pair[0] + pair[1]) == [p for p in pair if p]
        return known

    def encode_sorted(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian, 32 bits each) of ascending words: the depth-first walk of their trie.

        A prefix keeps its last piece, where that begins and, for a unigram model, its score; a word's ids
        are read back from its end, so memory follows the word's length.
        """
        out: list[bytes] = []
        last: list[str] = [""]  # by prefix length: last piece, its begin, score
        origin: list[int] = [0]
        scores: list[float] = [0.0]
        before = ""
        endings, packed, bpe, score, known, stands = self.endings, self.packed, self.bpe, self.score, self.compatible.get, self.stands
        for word in words:
            shared = 0
            for a, b in zip(before, word):  # noqa: B905  the shorter one ends it
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], origin[shared + 1 :]
            if not bpe:
                del scores[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, begin, begins = endings, end, []
                while begin:
                    node = node.get(word[begin - 1])
                    if node is None:
                        break
                    begin -= 1
                    if "" in node:
                        begins.append(begin)
                found, found_score = None, float("-inf")
                for begin in reversed(begins):
                    piece = word[begin:end]
                    if not bpe:
                        if scores[begin] + score[piece] > found_score:
                            found, at, found_score = piece, begin, scores[begin] + score[piece]
                    else:
                        pair = (last[begin], piece)
                        stand = known(pair)
                        if stand if stand is not None else stands(pair):
                            found, at = piece, begin
                            break
                if found is None:
                    found, at, found_score = word[end - 1], end - 1, scores[-1] + self.missing
                last.append(found)
                origin.append(at)
                if not bpe:
                    scores.append(found_score)
            ids, at = [], len(word)
            while at:
                piece = last[at]
                ids.append(packed[piece] if piece in packed else self._unknown_ids(piece))
                at = origin[at]
            out.append(b"".join(reversed(ids)))
            before = word
        return out

    def _keys(self, text: str) -> list[str]:
        """Cache keys of a text's words: a word with a mark goes without it, a word behind a line break with that."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.plain or "  " in text or " \n" in text or text[0] == " " or text[-1] == " ":
            found = self.words.findall((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))
            return [w[1:] if w[0] == MARK else w if w[0] == "\n" else _BARE + w for w in found]
        return text.replace("\n", " \n").split(" ")

    def _learn(self, new: set[str]) -> None:
        bare = sorted(k for k in new if k[:1] == _BARE or k[:1] == "\n" and self.plain)
        marked = sorted(new.difference(bare))
        self.cache.update(zip(bare, self.encode_sorted([k[1:] if k[0] == _BARE else k for k in bare]), strict=True))
        self.cache.update(zip(marked, self.encode_sorted([MARK + k for k in marked]), strict=True))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(x, "<u4") for x in ids_of_words([self._keys(t) if t else [] for t in texts], self.cache, self._learn, CACHE_WORDS)]

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts
        out = b"".join([texts[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


_models: dict[str, PieceModel] = {}


def model_of(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
        keep_warm("pieces", _models.clear)
    return _models[path]


def encode(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text", portion: int = 4_000_000) -> DataFrame:
    """One row per row of ``docs``: id, ids, n_tokens, and round_trip: whether the ids decode to the text.

    ``path`` names a model file that each executor can read, as part of an installed package. Texts of
    ``portion`` bytes go through at once: with less the worker holds less.
    """
    path = path or default_model()

    def run(batches):
        model = model_of(path)
        for batch in portions(batches, "text", portion):
            texts = batch.column(1).to_pylist()
            found = model.encode(texts)
            same = [model.decode(ids) == (t or "").replace(MARK, " ") for ids, t in zip(found, texts, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(np.diff(offsets).astype(np.int64)), pa.array(same)], names=[id, "ids", "n_tokens", "round_trip"])

    narrow = docs.select(F.col(id), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(lean(run, "pieces"), f"`{id}` {docs.schema[id].dataType.simpleString()}, ids array<int>, n_tokens long, round_trip boolean")


def decode(encoded: DataFrame, path: str | None = None, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id and text; null ids give an empty text."""
    path = path or default_model()

    def run(batches):
        model = model_of(path)
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id, "text"])

    return encoded.select(id, ids).mapInArrow(lean(run, "pieces"), f"`{id}` {encoded.schema[id].dataType.simpleString()}, text string")

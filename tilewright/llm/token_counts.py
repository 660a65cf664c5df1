"""Operator 6, token counts under a unigram vocabulary, with forward scores shared along a trie of pre-tokens.

A text is split at white space; each pre-token gets the word mark in front. The count of a pre-token is the number
of pieces in its best-scoring segmentation. A task keeps a trie: each distinct pre-token is inserted once, the forward score of
a prefix is computed when its node is made and holds for all pre-tokens that share it, and the terminal node's count is
stored and summed over the texts. A trie of more than MOST_NODES nodes is begun anew, which bounds memory and changes no count; a
pre-token of more than LONG characters is scored beside it.

Scores are the model's where the file is a unigram model. Other public vocabulary files hold ranks and no
probabilities; their scores follow Zipf's law over the rank order, log(1 / (rank * H)). Then a count is that of the best segmentation
under these scores, and of no published tokenizer. A character outside the vocabulary costs one piece for each of its UTF-8
bytes. Of equal scores the segmentation with fewer pieces counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import fresh

MARK = "▁"
MOST_NODES, LONG = 600_000, 256
BYTE_RANK = 1_000_000
Forward = tuple[float, int]


class Vocabulary:
    """Pieces with scores, and for each last character the piece lengths that end with it, shortest first."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores, self.byte_score = scores, byte_score
        ends: dict[str, set[int]] = {}
        for piece in scores:
            ends.setdefault(piece[-1], set()).add(len(piece))
        self.ends = {c: sorted(sizes) for c, sizes in ends.items()}
        self.longest = max(map(len, scores), default=1)

    @classmethod
    def ranked(cls, pieces: list[str]) -> Vocabulary:
        """Zipf's law over the order."""
        scale = math.log(sum(1 / r for r in range(1, len(pieces) + 1))) if pieces else 0.0
        scores: dict[str, float] = {}
        for rank, piece in enumerate(pieces, 1):
            scores.setdefault(piece, -math.log(rank) - scale)
        return cls(scores, -math.log(BYTE_RANK) - scale)

    @classmethod
    def from_sentencepiece(cls, path: str) -> Vocabulary:
        """A unigram model's scores; of a file whose scores only count ranks, the ranks."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in normal}
        if all(float(x).is_integer() for x in scores.values()):
            return cls.ranked([model.id_to_piece(i) for i in normal])
        return cls(scores, min(scores.values()) - 10.0)

    def forward(self, word: str, end: int, path: list[Forward], first: int = 0) -> Forward:
        """(score, pieces) of the prefix ``word[:end]``; path[k - first] is that of the prefix of length k."""
        scores, last = self.scores, word[end - 1]
        best, pieces = -math.inf, 0
        for size in self.ends.get(last, ()):
            if size > end:
                break
            s = scores.get(word[end - size : end])
            if s is not None:
                before, n = path[end - size - first]
                s += before
                if s > best or (s == best and n + 1 < pieces):
                    best, pieces = s, n + 1
        if last not in scores:
            width = len(last.encode("utf-8", "surrogatepass"))
            before, n = path[end - 1 - first]
            s = before + width * self.byte_score
            if s > best:
                best, pieces = s, n + width
        return best, pieces


class Trie:
    """Pre-tokens by their characters; each node has the forward score of its prefix."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.kids: dict[tuple[int, str], int] = {}
        self.scored: list[Forward] = [(0.0, 0)]
        self.counts: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of a pre-token."""
        if (known := self.counts.get(word)) is not None:
            return known
        marked = MARK + word
        if len(marked) > LONG:
            return self._beside(marked)
        node, kids, scored, path = 0, self.kids, self.scored, [(0.0, 0)]
        for end, c in enumerate(marked, 1):
            below = kids.get((node, c))
            if below is None:
                below = kids[node, c] = len(scored)
                scored.append(self.vocabulary.forward(marked, end, path))
            node = below
            path.append(scored[node])
        self.counts[word] = path[-1][1]
        return path[-1][1]

    def _beside(self, marked: str) -> int:
        path, first, most = [(0.0, 0)], 0, 2 * self.vocabulary.longest + 256
        for end in range(1, len(marked) + 1):
            path.append(self.vocabulary.forward(marked, end, path, first))
            if len(path) > most:
                cut = len(path) - self.vocabulary.longest - 1
                del path[:cut]
                first += cut
        return path[-1][1]


def count_tokens(docs: DataFrame, vocabulary_path: str, key: list[str], text: str = "text", most_nodes: int = MOST_NODES) -> DataFrame:
    """One row per document: key columns, n_tokens, n_pretokens.

    Null, empty and blank texts have 0 of either. Counts are of whole texts; repeated rows give repeated results, and an
    empty table gives an empty one. A result column that clashes with ``key`` gets a trailing underscore. ``vocabulary_path``
    must be readable on the driver; the vocabulary (a fixed file) is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary.from_sentencepiece(vocabulary_path))
    mine = docs.select(*[F.col(f"`{k}`") for k in key])
    names, body = [fresh(mine, n) for n in ("n_tokens", "n_pretokens")], fresh(mine, "_text")
    shape = ", ".join([*[f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key], *[f"`{n}` bigint" for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(held.value)
        for batch in batches:
            tokens, pretokens = [], []
            for text in batch.column(len(key)):
                if len(trie.scored) > most_nodes:
                    trie = Trie(held.value)
                known, words = trie.counts, (text.as_py() or "").split()
                for w in {w for w in words if w not in known}:
                    known[w] = trie.count(w)
                tokens.append(sum(map(known.__getitem__, words)))
                pretokens.append(len(words))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(tokens, pa.int64()), pa.array(pretokens, pa.int64())], [*key, *names])

    return docs.select(*[F.col(f"`{k}`") for k in key], F.col(f"`{text}`").alias(body)).mapInArrow(run, shape)

"""Token counts by greedy longest-match word pieces, in time linear in the text.

The vocabulary is a trie of word-start pieces and one of continuing pieces. Every node has a
failure link: where matching goes on when the next character has no edge, and the number of
pieces that are complete by then. A word's length in pieces is the sum of these counts on its way;
no piece is ever built (the scheme of "Fast WordPiece Tokenization", Song et al. 2021).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.tables import give_back, text_batches

START, INNER = 0, 1
#: Words whose length a task remembers, about 20 MB; it starts again when there are more. Speed only.
CACHED = 150_000
CACHED_CHARS = 32


def read_pieces(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Word-start and continuing pieces of a sentencepiece model; ``mark`` tells the former."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    start, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        bare = piece.removeprefix(mark)
        if bare and mark not in bare:
            (start if piece != bare else inner).append(bare)
    return start, inner


class Automaton:
    """Trie with failure links and counts of popped pieces."""

    def __init__(self, start: Sequence[str], inner: Sequence[str]) -> None:
        self.edges: list[dict[str, int]] = [{}, {}]
        ends: set[int] = set()
        for root, pieces in ((START, start), (INNER, inner)):
            for piece in pieces:
                node = root
                for char in piece:
                    step = self.edges[node].get(char)
                    if step is None:
                        step = self.edges[node][char] = len(self.edges)
                        self.edges.append({})
                    node = step
                ends.add(node)
        #: Failure links (None: the word can't be matched) and the pieces that following one pops.
        self.link: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        level = [START, INNER]
        while level:
            below = []
            for parent in level:
                for char, node in self.edges[parent].items():
                    below.append(node)
                    if node in ends:
                        self.link[node], self.popped[node] = INNER, 1
                        continue
                    at, count = self.link[parent], self.popped[parent]
                    while at is not None and char not in self.edges[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at is not None:
                        self.link[node], self.popped[node] = self.edges[at][char], count
            level = below

    def pieces(self, word: str) -> int | None:
        """Number of pieces of a word, None if some part of it is in no piece."""
        edges, link, popped = self.edges, self.link, self.popped
        node: int | None = START
        count = 0
        for char in word:
            while (step := edges[node].get(char)) is None:
                count += popped[node]
                node = link[node]
                if node is None:
                    return None
            node = step
        while node != INNER:
            count += popped[node]
            node = link[node]
            if node is None:
                return None
        return count


class _Lengths(dict):
    """Pieces by word; 0 for words outside the vocabulary."""

    def __init__(self, automaton: Automaton) -> None:
        self._pieces = automaton.pieces

    def __missing__(self, word: str) -> int:
        found = self._pieces(word) or 0
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found


#: A worker's automata, by vocabulary; the words go with the task.
_LENGTHS: dict[str, _Lengths] = {}


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_unknown, n_tokens`` of every whole text.

    Words are what white space separates; a word that can't be pieced together is one unknown
    token. Null and empty texts have no words. A row comes out for each row, whatever its key,
    its copies and its other columns. Nothing is shuffled; the vocabulary (about 32,000 pieces)
    is read on the driver and goes out as a broadcast variable.
    """
    docs = text_batches(docs, key, text)
    pieces = docs.sparkSession.sparkContext.broadcast(read_pieces(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _LENGTHS.get(vocabulary)
        if lengths is None:
            lengths = _LENGTHS[vocabulary] = _Lengths(Automaton(*pieces.value))
        try:
            for batch in batches:
                words, unknown, tokens = [], [], []
                for value in batch.column("text"):
                    found = [lengths[word] for word in (value.as_py() or "").split()]
                    lost = found.count(0)
                    words.append(len(found))
                    unknown.append(lost)
                    tokens.append(sum(found) + lost)
                counts = [pa.array(c, pa.int64()) for c in (words, unknown, tokens)]
                names = ["doc_id", "n_words", "n_unknown", "n_tokens"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts], names)
        finally:
            lengths.clear()
            give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, n_unknown bigint, n_tokens bigint"
    return docs.mapInArrow(run, schema)

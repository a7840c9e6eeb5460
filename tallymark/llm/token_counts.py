"""Token counts by a unigram vocabulary: forward scores in a trie, once for each prefix that words share.

The best segmentation of a word's first n characters depends on those alone, so words with a common prefix share its
scores. A task puts the distinct words it meets into a trie; a new node is scored from the nodes above it, and the
node where a word ends holds the word's token count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from tallymark.llm.common import Lists, add_columns

#: Marks the start of a word, as in the vocabulary's pieces.
START = "▁"


def zipf_scores(model: str) -> dict[str, float]:
    """Log probabilities of a SentencePiece vocabulary's pieces, by Zipf's law on their rank in the file."""
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = [
        vocabulary.id_to_piece(i)
        for i in range(vocabulary.get_piece_size())
        if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i))
    ]
    total = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    return {piece: -math.log(r) - total for r, piece in enumerate(plain, 1)}


class Trie:
    """Words, their shared prefixes' best scores, and token counts.

    Of segmentations with equal scores the one with fewer tokens counts. A character that is no piece is one token of
    ``unknown`` score. At ``limit`` nodes the trie starts anew, which costs time but changes no count.
    """

    def __init__(self, scores: dict[str, float], unknown: float | None = None, limit: int = 700_000):
        self.scores = scores
        self.suffixes = {piece[i:] for piece in scores for i in range(len(piece))}
        self.unknown = min(scores.values(), default=0.0) - 10 if unknown is None else unknown
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # by node and code point
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a word in its best segmentation."""
        known = self.terminal.get(word)
        if known is None:
            if len(self.score) > self.limit:
                self._clear()
            known = self.terminal[word] = self._insert(word)
        return known

    def _insert(self, word: str) -> int:
        nodes, node = [0], 0
        for end, char in enumerate(word, 1):
            key = node << 21 | ord(char)
            to = self.child.get(key)
            if to is None:
                to = self.child[key] = len(self.score)
                score, tokens = self._forward(word, end, nodes)
                self.score.append(score)
                self.tokens.append(tokens)
            nodes.append(to)
            node = to
        return self.tokens[node]

    def _forward(self, word: str, end: int, nodes: list[int]) -> tuple[float, int]:
        best, count = -math.inf, 0
        for start in range(end - 1, -1, -1):
            part = word[start:end]
            piece = self.scores.get(part)
            if piece is None and start == end - 1:
                piece = self.unknown
            elif part not in self.suffixes:
                break  # no longer piece ends here either
            elif piece is None:
                continue
            score, tokens = self.score[nodes[start]] + piece, self.tokens[nodes[start]] + 1
            if score > best or score == best and tokens < count:
                best, count = score, tokens
        return best, count


def token_counts(documents: DataFrame, scores: dict[str, float], text: str = "text", limit: int = 700_000) -> DataFrame:
    """All columns of ``documents`` and ``n_words`` and ``n_tokens``; columns of these names are replaced.

    Words are runs without ASCII white space, each with the start mark before it. A null or empty text has no words
    and no tokens. Every row is counted on its own; nothing is shuffled; memory holds one batch and one trie. The
    vocabulary is sent to each executor once.
    """
    shared = documents.sparkSession.sparkContext.broadcast(scores)

    def begin():
        trie = Trie(shared.value, limit=limit)

        def add(cols: Lists) -> Lists:
            words, tokens, count = [], [], trie.count
            for raw in cols[text]:
                split = (raw or b"").split()
                words.append(len(split))
                tokens.append(sum([count(START + w.decode("utf-8", "replace")) for w in split]))
            return {"n_words": words, "n_tokens": tokens}

        return add

    return add_columns(documents, [text], begin, "n_words long, n_tokens long", per_task=True)

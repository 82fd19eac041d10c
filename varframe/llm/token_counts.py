"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a
word. The best score of all ways to reach a position is kept together with the number of
tokens of that way, for the last few positions only (as many as the longest piece has
characters): no segmentation is built, and a word of any length needs the same memory.

The rules are those of the tokenizers library's unigram model: scores are summed from the
left as doubles; of equal scores the way whose last piece begins first wins; a character
that is no piece by itself may be unknown, at the lowest score less 10; neighbouring
unknown characters are one piece; an unknown piece counts its UTF-8 bytes if the vocabulary
has all byte pieces, else 1. Text is cut before each blank, which becomes U+2581; the text
gets one in front if it has none.

Defined results: null and empty texts have no tokens; repeated rows give repeated rows; an
empty table gives an empty result; all columns of the documents are kept in ``doc``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .common import map_docs, ready, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0


class Counter:
    """Counts the tokens of texts; keeps the counts of words it has met, up to ``words`` of them."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int, words: int = 400_000):
        import ahocorasick

        self.limit, self.known = words, {}
        self.pieces = {p: i for i, (p, _) in enumerate(pieces)}
        self.unknown = unknown
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.bytes_known = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.matches = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            if piece:
                self.matches.add_word(piece, (len(piece), pieces[i][1], i == unknown))
        self.matches.make_automaton()
        self.longest = max(map(len, self.pieces), default=1)

    def _unknown_size(self, text: str) -> int:
        if text in self.pieces:
            return 1
        return len(text.encode("utf-8", "surrogatepass")) if self.bytes_known else 1

    def count_word(self, word: str) -> int:
        ring = self.longest + 1
        score, count = [0.0] * ring, [0] * ring
        opened = [-1] * ring  # where the unknown run that ends here began
        single = -1  # the last character that is a piece by itself
        at = 0  # characters whose best way is settled
        best = None
        n = len(word)

        def settle(end: int) -> None:
            nonlocal best
            slot, before = end % ring, (end - 1) % ring
            if single != end:  # the character before ``end`` may be unknown
                s = score[before] + self.unknown_score
                if best is None or s > best[0]:
                    best = (s, end - 1, True)
            s, start, unknown = best
            origin = start % ring
            tokens, run = count[origin], opened[origin]
            if unknown:
                run = start if run < 0 else run
            else:
                if run >= 0:
                    tokens += self._unknown_size(word[run:start])
                tokens, run = tokens + 1, -1
            score[slot], count[slot], opened[slot] = s, tokens, run
            best = None

        for last, (size, weight, unknown) in self.matches.iter(word):
            end = last + 1
            while at < end - 1:
                at += 1
                settle(at)
            if size == 1:
                single = end
            start = end - size
            s = score[start % ring] + weight
            if best is None or s > best[0] or (s == best[0] and start < best[1]):
                best = (s, start, unknown)
        while at < n:
            at += 1
            settle(at)
        slot = n % ring
        return count[slot] + (self._unknown_size(word[opened[slot]:]) if opened[slot] >= 0 else 0)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        words = (text[1:] if text[0] == MARK else text).split(MARK)
        known = self.known
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            pass
        total = 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = self.count_word(MARK + w)
                if len(w) <= 64:
                    if len(known) >= self.limit:
                        known.clear()
                    known[w] = n
            total += n
        return total


def vocabulary(model_path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, and the unknown piece's number, of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``doc`` (all columns) and n_tokens, the tokens of the whole text."""
    spark = ready(docs.sparkSession)
    sent, name = spark.sparkContext.broadcast(vocabulary(model_path)), uuid.uuid4().hex

    def make():
        if name not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[name] = Counter(*sent.value)
        counter = _COUNTERS[name]
        return lambda texts: [[counter.count(t) for t in texts]]

    return map_docs(docs, text_col, "n_tokens long", make)


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_token_counts(spark, sf_dir):
    """The number of tokens of every document."""
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, model_file()).select("doc.doc_id", "n_tokens")

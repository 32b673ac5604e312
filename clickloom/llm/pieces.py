"""SentencePiece encoding and decoding by a merge-type prefix table.

A sequence of pieces is the encoding of a text exactly if each two neighbours are the
encoding of the two joined. So every prefix of a text has one last piece: the piece that
ends there (found by an Aho-Corasick automaton, the longest first) and that may follow the
last piece of what is left before it (the pair test). The ids are read off backwards. The
automaton knows the pieces of two characters and more: since every prefix has a last piece,
it is the character itself where no longer one may follow, and that needs no test.

The pair test goes back in time. Two pieces side by side were made by merges of their own;
undone one by one, the last first, these leave what stood at the border before. If that could
have been merged across the border, earlier than the merge that was undone, the two pieces
never come about. A model where a piece is not scored below its parts is refused.

A character without a piece takes part in no merge and becomes its UTF-8 bytes. No piece has
a word mark after another character, and a line feed has no piece, so a text falls into runs
that are encoded on their own. Runs and pair tests are remembered within a number of bytes.

Decoding looks at ids only: it joins the bytes of the pieces and reads them as UTF-8.

Defined results: null is the empty text, whose only id is the end id. Every row is
encoded on its own; ids, repeated rows and other columns do not matter.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.llm.common import Memo, Recent

MARK = "▁"
RUNS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
# Bytes for the runs that a worker remembers, and what one takes beside its text and ids.
RUN_BYTES = 48 << 20
ENTRY_BYTES = 220
PAIR_MEMO = 300_000
LONGEST_REMEMBERED = 64
RESULT = "ids array<int>, decoded string"


class PrefixTable:
    """Encodes with the pieces and scores of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        self.bytes, self.byte, self.piece, self.score = {}, {}, {}, {}
        self.text = [""] * model.get_piece_size()
        for i in range(len(self.text)):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(text[3:5], 16)] = i
                self.byte[i] = int(text[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if MARK in text.lstrip(MARK) or "\n" in text:
                    raise ValueError(f"a piece with a word mark or line feed inside: {text!r}")
                self.piece[text] = i
                self.text[i] = text
                self.score[text] = model.get_score(i)
        if len(self.text) > 1 << 16:
            raise ValueError("a model of more than 65,536 pieces")
        self.names = list(map(str, range(len(self.text))))
        # Marks become spaces here: those made of byte pieces stay marks.
        shown = [text.replace(MARK, " ").encode() for text in self.text]
        self.shown = [bytes((self.byte[i],)) if i in self.byte else text for i, text in enumerate(shown)]
        self.single = {text: i for text, i in self.piece.items() if len(text) == 1}
        self.lengths = list(map(len, self.text))
        # Only pieces that their own text is merged to can ever come about.
        self.parts: list[tuple[str, str] | None] = [None] * len(self.text)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.piece.items():
            parts, last = self.merged(text)
            if parts == [text]:
                self.parts[i] = last
                if last and any(len(x) > 1 and self.score[x] < self.score[text] for x in last):
                    raise ValueError(f"a piece with a better score than its part: {text!r}")
                if len(text) > 1:
                    self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        # The same by ids, for the pair test: a piece's score, the last two pieces that were merged
        # to it, and the scores of two pieces joined.
        self.scores = [self.score.get(text, 0.0) for text in self.text]
        self.halves = [last and (self.piece[last[0]], self.piece[last[1]]) for last in self.parts]
        self.joined: dict[int, float] = {}
        for text, score in self.score.items():
            for at in range(1, len(text)):
                a, b = self.piece.get(text[:at]), self.piece.get(text[at:])
                if a is not None and b is not None:
                    self.joined[a << 16 | b] = score
        self.pairs = Memo(PAIR_MEMO)
        self.runs = Recent(RUN_BYTES, lambda run, ids: ENTRY_BYTES + 2 * len(run) + 8 * len(ids))

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging: the best-scored adjacent pair first, the leftmost among equals; what
        is left, and the last two that were merged."""
        parts = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap, last = [], None

        def offer(i):
            j = after[i]
            if j < len(text) and (s := self.score.get(parts[i] + parts[j])) is not None:
                heap.append((-s, i, len(parts[i]) + len(parts[j])))
                return True

        for i in range(len(parts) - 1):
            offer(i)
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i] if parts[i] else len(text)
            if j >= len(text) or len(parts[i]) + len(parts[j]) != size or not parts[i]:
                continue
            last = parts[i], parts[j]
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] < len(text):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and offer(k):
                    heappush(heap, heap.pop())
        return [x for x in parts if x], last

    def follows(self, a: int, b: int) -> bool:
        """Whether two pieces side by side are the encoding of their texts joined."""
        scores, halves, joined = self.scores, self.halves, self.joined.get
        if joined(a << 16 | b) is not None:
            return False
        while True:
            left, right = halves[a], halves[b]
            # Of equal merges the left one comes first, so the right one is undone first.
            if right is not None and (left is None or scores[b] <= scores[a]):
                undone, b = scores[b], right[0]
                if joined(a << 16 | b, undone - 1) >= undone:
                    return False
            elif left is not None:
                undone, a = scores[a], left[1]
                if joined(a << 16 | b, undone) > undone:
                    return False
            else:
                return True

    def encode_run(self, run: str) -> tuple[int, ...]:
        # The last piece up to each character, at first the character itself; -1 for one without
        # a piece, and (as the last entry, which stands before the first) for the start.
        single = self.single.get
        last = [single(x, -1) for x in run]
        last.append(-1)
        known, found = self.pairs.get, -1
        for at, (size, i) in self.automaton.iter(run):
            if at != found:
                left = last[at - size]
                if left >= 0:
                    fits = known(left << 16 | i)
                    if not fits:
                        if fits is None:
                            fits = self.pairs.keep(left << 16 | i, self.follows(left, i))
                        if not fits:
                            continue
                last[at] = i
                found = at
        ids, lengths, at = [], self.lengths, len(run) - 1
        while at >= 0:
            i = last[at]
            if i == -1:
                ids += [self.bytes[x] for x in reversed(run[at].encode())]
                at -= 1
            else:
                ids.append(i)
                at -= lengths[i]
        ids.reverse()
        return tuple(ids)

    def run(self, run: str) -> tuple[int, ...]:
        known = self.runs.get(run)
        if known is None:
            known = self.encode_run(run)
            if len(run) <= LONGEST_REMEMBERED:
                self.runs.keep(run, known)
        return known

    def encode(self, text: str | None) -> list[int]:
        """The ids, the end id last."""
        marked = (MARK + text.replace(" ", MARK)) if text else ""
        runs = RUNS.findall(marked)
        found = list(map(self.runs.young.get, runs))
        if None in found:
            for at, known in enumerate(found):
                if known is None:
                    found[at] = self.run(runs[at])
        return [*chain.from_iterable(found), self.end]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the mark that encoding put before the first word."""
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")[1:]


@cache
def _table(path: str) -> PrefixTable:
    return PrefixTable(path)


def encode(text: Column, model_path: str) -> Column:
    """A struct of the ids, the end id last, and the text decoded from them."""

    @F.pandas_udf(RESULT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _table(model_path)
        for texts in batches:
            rows = []
            for x in texts:
                ids = table.encode(x)
                rows.append((ids, table.decode(ids)))
            yield pd.DataFrame(rows, columns=["ids", "decoded"])

    return of(text)


def encode_digest(text: Column, model_path: str) -> Column:
    """A struct of n_tokens and the digests of the ids and of the decoded text; the same
    encoding, but the ids need not leave the worker."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _table(model_path)
        for texts in batches:
            rows = []
            for x in texts:
                ids = table.encode(x)
                named = " ".join(map(table.names.__getitem__, ids))
                decoded = table.decode(ids)
                rows.append((len(ids), hashlib.sha256(named.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return of(text)

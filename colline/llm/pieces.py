"""SentencePiece BPE by a prefix table: the encoder, the decoder and the text segments.

Segments.  A merge joins two neighbours only if their concatenation is a piece,
so a boundary that lies inside no piece is never crossed and the segments on
its two sides encode independently.  :func:`segment_patterns` cut between
letters, digits, line ends and other characters and before every run of
spaces; :class:`Segmenter` checks on loading that no piece of the vocabulary
is cut, and otherwise cuts before runs of spaces only (and, if even that cuts
a piece, not at all).

Encoder.  For every prefix of a segment the BPE encoding has one last token.
The automaton lists the pieces that end at each position; a piece is the
prefix's last token exactly if it is compatible with the last token of the
prefix in front of it: merging the two together gives these two again.  The
compatibility of a pair is decided once, by merging its few characters, and
remembered.  The ids are then read backwards from the last position.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece

SPACE = "▁"  # the mark that stands for a space in pieces

# Segments longer than this are encoded, but not remembered.
REMEMBERED_LENGTH = 48


def load_processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def segment_patterns(letters: set[str]) -> list[str]:
    """Regular expressions that cut a text (with :data:`SPACE`) into segments, finest first."""
    cls = "".join(re.escape(c) for c in sorted(letters))
    fine = [f"{SPACE}*[{cls}]+", f"{SPACE}*[^{SPACE}\\n0-9{cls}]+", f"{SPACE}+", "[0-9]", "\\n+"] if cls else []
    return (["|".join(fine)] if fine else []) + [f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", r"[\s\S]+"]


class Segmenter:
    """Cuts a text into segments that the model encodes independently."""

    def __init__(self, processor: sentencepiece.SentencePieceProcessor):
        n = processor.get_piece_size()
        special = [processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) for i in range(n)]
        self.pieces = {processor.id_to_piece(i): i for i in range(n) if not special[i]}
        letters = {c for p in self.pieces for c in p if c.isalpha()}
        for pattern in segment_patterns(letters):
            self.pattern = pattern
            self.find = re.compile(pattern).findall
            if all(len(self.find(p)) == 1 for p in self.pieces):
                break

    def __call__(self, text: str | None) -> list[str]:
        """The segments of a text with the leading space that the library adds; none for no text."""
        return self.find(SPACE + text.replace(" ", SPACE)) if text else []


class PrefixCodec:
    """Encoder and decoder of one SentencePiece BPE model with byte fallback."""

    def __init__(self, model: bytes):
        sp = load_processor(model)
        self.segments = Segmenter(sp)
        ids = self.segments.pieces
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.text[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.score = {p: sp.get_score(i) for p, i in ids.items()}
        self.ids = ids
        self.length = [len(t) for t in self.text]
        self.automaton = ahocorasick.Automaton()
        for p, i in ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known = {p for p in ids if len(p) == 1}
        self.unknown_runs = re.compile(f"([^{''.join(map(re.escape, sorted(self.known)))}]+)")

    def _merge(self, s: str) -> list[str]:
        """BPE of a short string by its definition: best score first, leftmost on ties."""
        out = list(s)
        while True:
            best, at = None, -1
            for i in range(len(out) - 1):
                score = self.score.get(out[i] + out[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return out
            out[at : at + 2] = [out[at] + out[at + 1]]

    def _fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a (a = -1: b starts the segment)."""
        known = self.compatible.get((a, b))
        if known is None:
            left, right = self.text[a] if a >= 0 else "", self.text[b]
            known = self._merge(left + right) == ([left, right] if left else [right])
            self.compatible[a, b] = known
        return known

    def _encode_known(self, s: str) -> list[int]:
        """Ids of a string of vocabulary characters, from its table of last tokens."""
        if s in self.ids and self._fits(-1, self.ids[s]):
            return [self.ids[s]]
        last: list[int | None] = [None] * len(s) + [-1]  # by end position; at -1 the empty prefix
        compatible, fits, length = self.compatible.get, self._fits, self.length
        for end, token in self.automaton.iter(s):
            if last[end] is None:
                before = last[end - length[token]]
                if before is not None:
                    ok = compatible((before, token))
                    if ok is None:
                        ok = fits(before, token)
                    if ok:
                        last[end] = token
        out, at = [], len(s) - 1
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= length[token]
        return out[::-1]

    def encode_segment(self, segment: str) -> list[int]:
        if self.known.issuperset(segment):
            return self._encode_known(segment)
        out: list[int] = []
        for k, part in enumerate(self.unknown_runs.split(segment)):
            if k % 2:
                if self.id_of_byte:
                    out += [self.id_of_byte[b] for b in part.encode("utf-8")]
                else:
                    out.append(self.unknown)  # the library joins a run of unknown characters
            elif part:
                out += self._encode_known(part)
        return out

    def encode(self, text: str | None) -> list[int]:
        return [i for s in self.segments(text) for i in self.encode_segment(s)]

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of ids, with the leading space of the first piece still there."""
        out, pending = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                pending.append(byte)
                continue
            if pending:
                out.append(pending.decode("utf-8", errors="replace"))
                pending.clear()
            if i == self.unknown:
                out.append(" ⁇ ")  # fixed value: how the library shows the unknown id
            elif i not in self.silent:
                out.append(self.text[i].replace(SPACE, " "))
        if pending:
            out.append(pending.decode("utf-8", errors="replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_pieces(ids)
        return text[1:] if text.startswith(" ") else text


class Remembered(dict):
    """A bounded cache ``segment -> value`` of one Python worker.

    ``first`` (frequent segments, never dropped) is in it from the start.  When
    the cache is full, it starts again from ``first``, so memory is bounded
    whatever the texts hold; values do not depend on what is remembered.
    """

    def __init__(self, make, first: dict | None = None, most: int = 300_000):
        super().__init__(first or {})
        self.make, self.first, self.most = make, first or {}, most + len(first or {})

    def __missing__(self, segment: str):
        value = self.make(segment)
        if len(segment) <= REMEMBERED_LENGTH:
            if len(self) >= self.most:
                self.clear()
                self.update(self.first)
            self[segment] = value
        return value

"""Quality rules (operator 4): a short-circuit cascade ordered by rejection per cost.

Every rule looks at one text and rejects it or not.  Before the main pass each
rule runs on those of the first rows of every input partition that pass the base
rule; this gives its cost and, through the set of rules that reject each sampled
text, its selectivity among the texts that earlier rules let pass.  The measures
of the result cost a rule nothing, as they are taken of every text.  A measure
that several rules share and the result does not have is timed by itself and
charged to the rule that comes first in the cascade.  The cascade takes, again
and again, the rule with the highest rejection per cost among the texts still
alive, and a text leaves it at the first rule that rejects it.  The order
changes the time, never the verdict: a text is kept exactly if no rule rejects it.
"""

from __future__ import annotations

import operator
import time
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# Rows of every input partition from which the texts come on which the rules are timed.
SAMPLED_PER_PARTITION = 12


@cache
def _kinds() -> np.ndarray:
    """For every code point: 1 if a letter (category L), + 2 if a capital (Lu), + 4 if a small letter (Ll)."""
    kinds = map(unicodedata.category, map(chr, range(0x110000)))
    return np.array([(k[0] == "L") + 2 * (k == "Lu") + 4 * (k == "Ll") for k in kinds], dtype=np.uint8)


class Text:
    """One text and its measures, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at exactly the code points of SPACES
        return self.text.encode("utf-8").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def letters(self) -> tuple[int, int, int]:
        """Letters, capitals and small letters."""
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = np.bincount(_kinds()[codes], minlength=8)
        return int(n[1::2].sum()), int(n[[2, 3, 6, 7]].sum()), int(n[4:].sum())

    @cached_property
    def lines(self) -> list[str]:
        """The lines that have a word."""
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def repeat_words(self) -> int:
        """Words inside 5-word windows that occur twice or more in the text."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:]))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        covered = until = 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 5 - max(i, until)
                until = i + 5
        return covered


@dataclass(frozen=True)
class Rule:
    """``needs``: the measures of :class:`Text` it reads that are not in the result."""

    name: str
    rejects: Callable[[Text], bool]
    needs: tuple[str, ...] = ()


def _mean_length(t: Text) -> bool:
    return bool(t.words) and not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)


def _symbols(t: Text) -> bool:
    return 10 * t.symbols > len(t.words)


def _dup_lines(t: Text) -> bool:
    """More than half of the lines with a word repeat an earlier line."""
    return 2 * t.dup_lines > len(t.lines)


def _letters(t: Text) -> bool:
    """Fewer than 40 % of the characters of words are letters."""
    return 10 * t.letters[0] < 4 * t.word_chars


def _capitals(t: Text) -> bool:
    """More than half of the cased letters are capitals (texts with 20 capitals or more)."""
    _, upper, lower = t.letters
    return upper >= 20 and upper > lower


def _exclamations(t: Text) -> bool:
    return 4 * t.text.count("!") > len(t.words)


def _one_word(t: Text) -> bool:
    """One word makes up more than a quarter of a text of 20 words or more."""
    return len(t.words) >= 20 and 4 * Counter(t.words).most_common(1)[0][1] > len(t.words)


def _stutter(t: Text) -> bool:
    """More than 30 % of the words equal the word before them."""
    return 10 * sum(map(operator.eq, t.words, t.words[1:])) > 3 * len(t.words)


def _ellipses(t: Text) -> bool:
    return len(t.lines) >= 3 and 10 * sum(x.rstrip(SPACES).endswith(("...", "…")) for x in t.lines) > 3 * len(t.lines)


def _bullets(t: Text) -> bool:
    return len(t.lines) >= 3 and 10 * sum(x.lstrip(SPACES).startswith(("-", "*", "•")) for x in t.lines) > 9 * len(t.lines)


RULES = (
    Rule("mean_word_length", _mean_length),
    Rule("symbols", _symbols),
    Rule("dup_lines", _dup_lines),
    Rule("letters", _letters, ("letters",)),
    Rule("capitals", _capitals, ("letters",)),
    Rule("exclamations", _exclamations),
    Rule("one_word", _one_word),
    Rule("stutter", _stutter),
    Rule("ellipses", _ellipses),
    Rule("bullets", _bullets),
)


def base_failed(t: Text) -> bool:
    return len(t.words) < 10 or 100 * t.repeat_words > 20 * len(t.words)


def _shared(rules: Sequence[Rule]) -> list[str]:
    """The measures that rules need beside those of the result."""
    return sorted({m for r in rules for m in r.needs})


def time_rules(texts: Iterable[str | None], rules: Sequence[Rule]) -> list[tuple[int, list[float]]]:
    """For each text that passes the base: the rules that reject it as bits; seconds of
    every rule with its measures present, then seconds of every shared measure."""
    out = []
    for text in texts:
        t = Text(text)
        if base_failed(t):
            continue
        for m in ("word_chars", "symbols", "lines", "dup_lines"):  # the result has them anyway
            getattr(t, m)
        mask, spent, seconds = 0, [], {}
        for m in _shared(rules):
            began = time.perf_counter()
            getattr(t, m)
            seconds[m] = time.perf_counter() - began
        for k, rule in enumerate(rules):
            began = time.perf_counter()
            mask |= bool(rule.rejects(t)) << k
            spent.append(time.perf_counter() - began)
        out.append((mask, spent + list(seconds.values())))
    return out


def cascade_order(
    sampled: Sequence[tuple[int, int]], costs: Sequence[float], rules: Sequence[Rule] | None = None, shared: Mapping[str, float] | None = None,
) -> list[int]:
    """Rule numbers, best first.

    ``sampled``: (set of rejecting rules as bits, number of sampled texts);
    ``costs``: seconds of each rule over the sample, without the measures of its
    ``needs``, whose seconds are in ``shared`` and are paid by the first rule
    that needs them (every text that reaches a later one has them by then).
    Ties: the cheaper rule, then the name, so the order of the list does not matter.
    """
    alive, left, order = list(sampled), list(range(len(costs))), []
    paid: set[str] = set()
    needs = lambda r: set(rules[r].needs) - paid if rules else ()
    name = lambda r: rules[r].name if rules else r
    while left:
        cost = {r: max(costs[r] + sum((shared or {}).get(m, 0.0) for m in needs(r)), 1e-9) for r in left}
        best = min(left, key=lambda r: (-sum(n for bits, n in alive if bits >> r & 1) / cost[r], cost[r], name(r)))
        order.append(best)
        left.remove(best)
        paid |= set(needs(best))
        alive = [(bits, n) for bits, n in alive if not bits >> best & 1]
    return order


def estimate_order(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> list[int]:
    """The cascade's order from the first rows of every partition; only these are sent to Python.

    The driver gets one row for each set of rules that rejected some sampled
    text together (2 ** rules at most), with counts and seconds.
    """
    shared = _shared(rules)
    names = [f"s{k}" for k in range(len(rules) + len(shared))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            timed = time_rules(batch.column(0).to_pylist(), rules)
            if timed:
                columns = [pa.array([m for m, _ in timed], pa.int64()), *[pa.array([c[k] for _, c in timed], pa.float64()) for k in range(len(names))]]
                yield pa.RecordBatch.from_arrays(columns, names=["bits", *names])

    ddl = ", ".join(["bits long", *[f"{n} double" for n in names]])
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # of a row in its partition
    rows = (
        docs.select(F.col(f"`{text_col}`").alias("text"))
        .where(place < SAMPLED_PER_PARTITION)
        .mapInArrow(run, ddl)
        .groupBy("bits")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names])
        .collect()
    )
    spent = [sum(r[n] for r in rows) for n in names]
    return cascade_order([(r["bits"], r["n"]) for r in rows], spent[: len(rules)], rules, dict(zip(shared, spent[len(rules) :])))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
    order: Sequence[int] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Base measures and the cascade's verdict of every whole text; one row per input row.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, rejected_by`` and the columns named in ``keep``
    unchanged.  ``rejected_by`` is ``base`` or the first rule of this run's
    order that rejects (null if kept); only ``kept`` is the same in every order.
    A null text counts as empty and fails the base rule; a null id stays null;
    repeated rows give repeated rows; an empty table gives an empty result.
    """
    rules = tuple(rules)
    if order is None:
        order = estimate_order(docs, text_col, rules)
    cascade = [rules[k] for k in order]
    fields = [("doc_id", pa.int64()), *[(m, pa.int64()) for m in MEASURES], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("rejected_by", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields[1:]]
            for text in batch.column(1).to_pylist():
                t = Text(text)
                failed = base_failed(t)
                by = "base" if failed else next((r.name for r in cascade if r.rejects(t)), None)
                row = (len(t.words), t.word_chars, t.symbols, t.dup_lines, t.repeat_words, failed, by is None, by)
                for column, value in zip(out, row):
                    column.append(value)
            arrays = [batch.column(0), *[pa.array(c, kind) for c, (_, kind) in zip(out, fields[1:])]]
            kept = [batch.column(2 + k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(arrays + kept, names=[f for f, _ in fields] + [f"_keep{k}" for k in range(len(keep))])

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        *[F.col(f"`{c}`").alias(f"_keep{k}") for k, c in enumerate(keep)],
    )
    ddl = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", base_failed boolean, kept boolean, rejected_by string"
    ddl += "".join(f", _keep{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    return rows.mapInArrow(run, ddl)

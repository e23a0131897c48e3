"""Secret scan: the regexes of all rules in one deterministic automaton, one byte pass a text.

The rules, read backwards, are compiled by subset construction into a single minimal
automaton (``automata.py``). One pass over the bytes of a text, from its end, tells for
every byte which rules have a match that begins there. From the leftmost such byte after a
rule's last match its own automaton runs on to the longest end, so matches of a rule are
leftmost, longest and do not overlap. No other byte is read twice.

A rule is a head and a value; matches whose value has fewer bytes than the rule asks for
are dropped, but still hide what they cover. Rules are ASCII and so are their matches;
spans are given in code points. The first three rules are the base; the others find kinds
of tokens that carry a prefix of their own, and never change what the base finds.

Defined results: null and empty texts have no spans; a row with a null id keeps it; rows
that repeat an id are scanned one by one; texts are scanned whole, whatever their length;
columns other than id and text are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.automata import Automaton


@dataclass(frozen=True)
class Rule:
    """``head`` then ``value`` is the regex; ``least`` the fewest bytes of the value."""

    kind: str
    head: str
    value: str
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# What the base kinds look like. A run of hexadecimal digits is a match only if
# it is long enough, so its least length may stand in the regex, and short runs begin nothing.
ASSIGN_HEAD = (
    "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?"
)
BASE = (
    Rule("assign", ASSIGN_HEAD, "[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", "", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "", "[0-9a-f]{32,}", 32),
)
# Token formats that their issuers publish.
PREFIXED = (
    Rule("private_key", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("github", "", "gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", "", "xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("google", "", "AIza[A-Za-z0-9_-]+", 39),
    Rule("payment", "", "[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", "", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 36),
)
RULES = BASE + PREFIXED

SPAN = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
)
# UTF-8 bytes that continue a character.
_INNER = bytes(range(0x80, 0xC0))


class Scanner:
    """All rules compiled: one automaton for where matches begin, two a rule for where they end."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        whole = [r.head + r.value for r in rules]
        self.begins = Automaton(whole, backwards=True, anywhere=True)
        self.match = [Automaton([w]) for w in whole]
        self.head = [Automaton([r.head]) if r.head else None for r in rules]

    def _begins(self, data: bytes) -> tuple[array, array]:
        """Places, from last to first, where rules begin, and the state that tells which."""
        auto = self.begins
        table, state, accepting = auto.table, auto.start, auto.accepting
        places, states = array("q"), array("q")
        left = len(data)
        for c in reversed(data.translate(auto.classes)):
            left -= 1
            state = table[state + c]
            if state >= accepting:
                places.append(left)
                states.append(state)
        return places, states

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start and then rule."""
        places, states = self._begins(data)
        done, found = [0] * len(self.rules), []
        which, width = self.begins.rules, self.begins.width
        for k in range(len(places) - 1, -1, -1):
            at, bits = places[k], which[states[k] // width]
            while bits:
                rule = (bits & -bits).bit_length() - 1
                bits &= bits - 1
                if at < done[rule]:
                    continue
                end = done[rule] = self.match[rule].longest(data, at)
                head = self.head[rule]
                value = head.longest(data, at) if head else at
                if end - value >= self.rules[rule].least:
                    found.append((at, rule, end))
        return found

    def named_spans(self, data: bytes) -> list[dict]:
        """The same in code points, with the kind's name."""
        out, read, points = [], 0, 0
        for start, rule, end in self.spans(data):
            points += len(data[read:start].translate(None, _INNER))
            read = start
            # Matches are ASCII: a byte is a character.
            out.append({"kind": self.rules[rule].kind, "start": points, "end": points + end - start})
        return out


def find_secrets(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(doc_id, spans): for each row the matches of all rules, by start and then rule."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body")
    )
    schema = T.StructType([rows.schema["doc_id"], T.StructField("spans", SPAN)])
    # Some ten thousand integers, whatever the data.
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [scanner.value.named_spans(body.as_py()) for body in batch.column("body")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, spans)], names=["doc_id", "spans"]
            )

    return rows.mapInArrow(run, schema)


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Per row: its id, the number of matches of each base kind, a digest of those, and all spans."""
    found = find_secrets(docs, **options)
    base = of_kinds(F.col("spans"), [r.kind for r in BASE])
    counts = [F.size(of_kinds(F.col("spans"), [r.kind])).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )

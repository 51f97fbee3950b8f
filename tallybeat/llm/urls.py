"""URL filters: host rules and globs, all matched at once by one bit-parallel automaton.

A canonical URL is ``.host/path``: the host in lower case behind a dot, then the path, without
scheme, query and fragment. Rules become globs over it: the rule ``example.net/en/``
is ``*.example.net/en/**``. Every pattern is a run of states, and the states of all
patterns lie side by side in words of 64 bits. One step per byte of the URL shifts
all states on and masks them by the byte (Shift-And); a second mask holds the states that may
stay where they are, which is what a wildcard does. Work is URLs times their bytes times words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm.text import whole

BLOCK, ALLOW = "block", "allow"
#: Host and path of a URL that has ``://``.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, a path that the URL's path begins with, and what to do."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Glob:
    """A pattern over canonical URLs: ``?`` is one character and ``*`` any run of them, both
    within host or one part of the path; ``**`` is any run; a backslash makes the next one plain."""

    pattern: str
    verdict: str


RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)
#: For URLs that no rule fits: hosts and paths that sell or show what no corpus wants.
GLOBS = (
    Glob("*.*spam*/**", BLOCK),
    Glob("*.*spam*", BLOCK),
    Glob("*.*casino*/**", BLOCK),
    Glob("*.*casino*", BLOCK),
    Glob("*.*free-bets*/**", BLOCK),
    Glob("*.*free-bets*", BLOCK),
    Glob("*.*porn*/**", BLOCK),
    Glob("*.*porn*", BLOCK),
    Glob("*.xxx/**", BLOCK),
    Glob("*.xxx", BLOCK),
    Glob("*/**/login", BLOCK),
    Glob("*/**/cart", BLOCK),
    Glob("*/**.exe", BLOCK),
    Glob("*/**.zip", BLOCK),
    Glob("*.ads.*/**", BLOCK),
)

_TOKEN = re.compile(r"\*\*|\\.|.", re.DOTALL)


def plain(text: str) -> str:
    """A glob that matches this text only."""
    return re.sub(r"([*?\\])", r"\\\1", text)


def as_glob(rule: Rule) -> str:
    return f"*.{plain(rule.host)}{plain(rule.path)}**"


class Automaton:
    """States of all patterns in words of 64 bits; ``step`` and ``stay`` are masks by byte.

    The first bit of a pattern is its begin, bit i stands for i bytes read. Bits are shifted
    over the borders of words; no byte lets a bit into the begin of the next pattern.
    """

    def __init__(self, patterns: Sequence[str]):
        step = [0] * 256
        stay = [0] * 256
        begins, self.ends, bit = 0, [], 0
        for pattern in patterns:
            begins |= 1 << bit
            for token in _TOKEN.findall(pattern):
                if token in ("*", "**"):
                    for byte in range(256):
                        if token == "**" or byte != ord("/"):
                            stay[byte] |= 1 << bit
                elif token == "?":
                    bit += 1
                    for byte in range(256):
                        if byte != ord("/") and not 0x80 <= byte < 0xC0:
                            step[byte] |= 1 << bit
                    for byte in range(0x80, 0xC0):  # the rest of the same character
                        stay[byte] |= 1 << bit
                else:
                    for byte in token[-1].encode():
                        bit += 1
                        step[byte] |= 1 << bit
            self.ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.step, self.stay = self._packed(step), self._packed(stay)
        self.begins = self._packed([begins])[0]

    def _packed(self, masks: list[int]) -> np.ndarray:
        size = 8 * self.words
        return np.array([np.frombuffer(m.to_bytes(size, "little"), "<u8") for m in masks], dtype=np.uint64)

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The states after each text; texts lie in ``data`` one behind the other.

        Texts go in falling length, so those still being read are always the first ones.
        """
        order = np.argsort(-lengths, kind="stable")
        at, left = starts[order], lengths[order]
        states = np.tile(self.begins, (len(order), 1))
        reading = np.searchsorted(-left, -np.arange(1, int(left.max(initial=0)) + 1), side="right")
        for position, n in enumerate(reading):
            byte = data[at[:n] + position]
            now = states[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.step[byte]
            moved |= now & self.stay[byte]
            states[:n] = moved
        out = np.empty_like(states)
        out[order] = states
        return out

    def matched(self, texts: pa.Array) -> np.ndarray:
        """One row per text and one column per pattern: whether it matches the whole text."""
        if len(texts) == 0:
            return np.zeros((0, len(self.ends)), dtype=bool)
        joined = texts.cast(pa.large_binary())
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        states = self.run(data, offsets[:-1], np.diff(offsets))
        words, bits = np.divmod(np.array(self.ends, dtype=np.int64), 64)
        return (states[:, words] >> bits.astype(np.uint64)) & np.uint64(1) == 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies behind the first ``://``; both empty for null and where there is none."""
    host = F.regexp_extract(whole(url), PARTS, 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(whole(url), PARTS, 2)


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    globs: Sequence[Glob] = GLOBS,
    default: str = ALLOW,
    cells: int = 1 << 20,
) -> DataFrame:
    """page_id, host, path, rule, glob, verdict: one row per page.

    Needs page_id and url; other columns are not read. Null and empty URLs, and those without
    ``://``, have an empty host and path, which no rule fits; ids may be null or repeat;
    equal URLs get equal results; an empty table gives an empty result; URLs may be of any
    length. The longest rule that fits wins; of equally long ones the one with the longer host, then
    the first. Without a rule, the longest glob that matches wins, the first of equal ones; without
    any, the verdict is ``default``. ``cells`` bounds the words of states held at once.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host)))  # a stable sort
    wild = sorted(globs, key=lambda g: -len(g.pattern))
    automaton = Automaton([*map(as_glob, ranked), *(g.pattern for g in wild)])
    names = [*(r.name for r in ranked), *[None] * len(wild), None]
    patterns = [*[None] * len(ranked), *(g.pattern for g in wild), None]
    verdicts = [*(r.verdict for r in ranked), *(g.verdict for g in wild), default]
    at_once = max(1, cells // automaton.words)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, at_once):
                part = batch.slice(begin, at_once)
                hits = automaton.matched(part.column("canonical"))
                best = np.where(hits.any(axis=1), hits.argmax(axis=1), len(verdicts) - 1) if hits.shape[1] else None
                best = np.zeros(part.num_rows, dtype=int) if best is None else best
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("page_id", "host", "path")),
                        *(pa.array(known, pa.string()).take(pa.array(best)) for known in (names, patterns, verdicts)),
                    ],
                    ["page_id", "host", "path", "rule", "glob", "verdict"],
                )

    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return parts.mapInArrow(
        answers, f"page_id {kind}, host string, path string, rule string, glob string, verdict string"
    )

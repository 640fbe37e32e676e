"""URL filter: a bit-parallel automaton that runs all glob rules over each URL at once.

Every pattern takes one bit per byte plus a start bit, packed side by side into 64-bit words. One
step of the automaton is a shift, an AND with the mask of the byte read, and an OR with the states
that a ``*`` keeps alive. The states of many URLs advance together as rows of one array, so a URL
costs its length times the number of words, whatever the number of patterns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from .common import narrow, texts, through_arrow

# Stands between host and path; UTF-8 never holds this byte.
BORDER = b"\xff"
CHUNK = 4096


@dataclass(frozen=True)
class UrlRules:
    """``(verdict, host, path)`` rules, and globs over ``host + path`` for all other URLs."""

    rules: tuple[tuple[str, str, str], ...] = (
        ("block", "net", "/"),
        ("allow", "example.net", "/en/"),
        ("block", "example.com", "/de/"),
        ("allow", "org", "/fr/"),
    )
    block_globs: tuple[str, ...] = (
        "*casino*", "*porn*", "*.xxx/*", "*.doubleclick.*", "*/ads/*", "*/banner?/*", "*.exe", "*/wp-admin/*", "*tracker.*/*",
    )


@dataclass
class Automaton:
    """Masks of all patterns; ``match`` tells for each text which patterns cover the whole of it."""

    patterns: list[bytes]
    words: int = field(init=False)

    def __post_init__(self) -> None:
        parsed = [_tokens(p) for p in self.patterns]
        bits = sum(len(tokens) + 1 for tokens, _ in parsed)
        self.words = max(1, -(-bits // 64))
        accept = np.zeros((256, self.words), np.uint64)
        start, loops = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.final, bit = [], 0
        for tokens, starred in parsed:
            _set(start, bit)
            for place in range(len(tokens) + 1):
                if place in starred:
                    _set(loops, bit + place)
                if place < len(tokens):
                    wanted = range(256) if tokens[place] is None else (tokens[place],)
                    for byte in wanted:
                        _set(accept[byte], bit + place + 1)
            bit += len(tokens) + 1
            self.final.append(divmod(bit - 1, 64))
        self.accept, self.start, self.loops = accept, start, loops

    def match(self, subjects: list[bytes]) -> np.ndarray:
        """Boolean array, one row per text and one column per pattern."""
        found = np.zeros((len(subjects), len(self.patterns)), bool)
        order = sorted(range(len(subjects)), key=lambda i: -len(subjects[i]))
        for at in range(0, len(order), CHUNK):
            part = order[at : at + CHUNK]
            lengths = np.array([len(subjects[i]) for i in part])
            state = np.repeat(self.start[None, :], len(part), axis=0)
            live = len(part)  # texts come longest first, so those still running are a prefix
            for place in range(int(lengths[0]) if len(part) else 0):
                live = int(np.searchsorted(-lengths[:live], -place, side="left"))
                byte = np.fromiter((subjects[i][place] for i in part[:live]), np.uint8, live)
                now = state[:live]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:live] = (moved & self.accept[byte]) | (now & self.loops)
            for column, (word, bit) in enumerate(self.final):
                found[part, column] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) > 0
        return found


def _tokens(pattern: bytes) -> tuple[list[int | None], set[int]]:
    """Bytes (None for ``?``) and the places where a ``*`` lets the automaton wait."""
    tokens, starred = [], set()
    for byte in pattern:
        if byte == ord("*"):
            starred.add(len(tokens))
        else:
            tokens.append(None if byte == ord("?") else byte)
    return tokens, starred


def _set(mask: np.ndarray, bit: int) -> None:
    mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)


def split_url(url: bytes) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = url.partition(b"://")
    if not found:
        return b"", b""
    cut = min((i for i in (rest.find(c) for c in (b"?", b"#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find(b"/")
    host, path = (rest, b"") if slash < 0 else (rest[:slash], rest[slash:])
    return host.lower(), path


def _rule_glob(host: str, path: str) -> bytes:
    return b"*." + host.encode() + BORDER + path.encode() + b"*"


def judge_urls(pages: DataFrame, rules: UrlRules = UrlRules(), id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    A rule fits its host and all subdomains when the path starts with the rule's path; the longest
    fitting rule decides (the earlier of two equally long ones). Without one, a URL is blocked when
    a glob covers ``.host + path``. A null URL or one without ``://`` has an empty host and path
    and is judged by the globs alone. Equal rows are judged alike, other columns are ignored, an
    empty table gives an empty table.
    """
    names = [f"{host}{path}" for _, host, path in rules.rules]
    ranked = sorted(range(len(names)), key=lambda i: (-len(names[i]), i))
    bordered = [_rule_glob(host, path) for _, host, path in rules.rules]
    rule_automaton = Automaton(bordered)
    glob_automaton = Automaton([glob.encode() for glob in rules.block_globs])

    def each(columns):
        parts = [split_url(u) for u in texts(columns["url"])]
        by_rule = rule_automaton.match([b"." + h + BORDER + p for h, p in parts])
        by_glob = glob_automaton.match([b"." + h + p for h, p in parts]).any(axis=1)
        rule, verdict = [], []
        for i in range(len(parts)):
            best = next((r for r in ranked if by_rule[i, r]), None)
            rule.append(None if best is None else names[best])
            verdict.append(("block" if by_glob[i] else "allow") if best is None else rules.rules[best][0])
        yield {
            "page_id": columns["page_id"],
            "host": [h.decode() for h, _ in parts],
            "path": [p.decode() for _, p in parts],
            "rule": rule,
            "verdict": verdict,
        }

    rows = narrow(pages, page_id=id, url=url)
    return through_arrow(rows, each, "page_id long, host string, path string, rule string, verdict string")

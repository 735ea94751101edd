"""Secret scan: known shapes by pattern, unknown ones by sliding-window entropy.

A candidate is a long run of characters that keys and tokens are made of. What the allow list knows in it (words, numbers,
UUIDs, public digests) is taken out, and only that. In what is left a window slides over the longest runs of each
character class; the counts of its characters are updated for the one that enters and the one that
leaves, and with them its Shannon entropy. Windows above the threshold of their class are joined to spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from sellerlens.llm.common import map_texts, read

# Fixed patterns and least lengths of the base kinds, in their order.
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LEAST_VALUE, _LEAST_ACCESS, _LEAST_HEX = 6, 20, 24

# Character classes of the entropy scan, the narrowest first: runs of at least a window, the window, and bits per
# character that a window needs. Runs of letters need more, because words are made of them too.
_CLASSES = {
    "entropy_hex": (re.compile(r"[0-9a-fA-F]{24,}"), 24, 3.0),
    "entropy_alnum": (re.compile(r"[0-9A-Za-z]{20,}"), 20, 3.6),
    "entropy_base64": (re.compile(r"[A-Za-z0-9+/=_-]{20,}"), 20, 3.8),
    "entropy_alpha": (re.compile(r"[A-Za-z]{32,}"), 32, 4.3),
}
KINDS = ("assign", "access", "hex", *_CLASSES)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")

# Allow list, fixed: what looks random in a candidate and is not secret.
_ALLOWED = re.compile(
    r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}(?![0-9A-Za-z])"  # UUIDs
    r"|(?<![0-9A-Za-z])(?i:sha(?:1|224|256|384|512))-[0-9A-Za-z+/]+={0,2}"  # integrity digests are public
    r"|(?i:0123456789(?:abcdef)?|abcdefghij(?:klmnopqrstuvwxyz)?|qwertyuiop)"  # keyboards and alphabets
    r"|(?i:example|placeholder|changeme|your[_-])"
    # Words and numbers between other characters.
    r"|(?<![0-9A-Za-z])(?:[A-Z]?[a-z]{2,31}|[A-Z]{3,31}|[0-9]+)(?![0-9A-Za-z])"
)

RESULT = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_entropy long"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    found = [
        (m.start(), 0, m.end())
        for m in _ASSIGN.finditer(text)
        if len(m[2]) >= _LEAST_VALUE
    ]
    found += [
        (m.start(), 1, m.end())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= _LEAST_ACCESS
    ]
    found += [
        (m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= _LEAST_HEX
    ]
    return sorted(found)


def high_entropy(run: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Joined (start, end) of all windows of ``run`` with at least ``bits`` per character.

    With n = window, the entropy is log2(n) - sum(c * log2(c)) / n over the counts c; one step of
    the window changes two counts, so it costs the same for any window.
    """
    part = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    most = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        total += part[c + 1] - part[c]
        counts[char] = c + 1
        if i >= window:
            gone = run[i - window]
            c = counts[gone]
            total += part[c - 1] - part[c]
            counts[gone] = c - 1
        if i >= window - 1 and total <= most:
            first = i - window + 1
            if first > end:
                if start >= 0:
                    yield start, end
                start = first
            end = i + 1
    if start >= 0:
        yield start, end


def _left_over(run: str) -> Iterator[tuple[int, str]]:
    """(start, piece) of what the allow list leaves of a candidate."""
    end = 0
    for m in _ALLOWED.finditer(run):
        if m.start() > end:
            yield end, run[end : m.start()]
        end = m.end()
    if end < len(run):
        yield end, run[end:]


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of high-entropy parts of candidates, without what the allow list excuses.

    What a narrower class has found is not given again. Only letters are no key unless they pass as letters.
    """
    found: list[tuple[int, int, int]] = []
    for m in _CANDIDATE.finditer(text):
        for offset, piece in _left_over(m[0]):
            here: list[tuple[int, int, int]] = []
            for kind, (made_of, window, bits) in enumerate(_CLASSES.values(), start=3):
                for part in made_of.finditer(piece):
                    run, at = part[0], m.start() + offset + part.start()
                    if run.isdigit() or (KINDS[kind] != "entropy_alpha" and run.replace("-", "").replace("_", "").isalpha()):
                        continue
                    for a, b in high_entropy(run, window, bits):
                        if not any(x <= at + a and at + b <= y for x, _, y in here):
                            here.append((at + a, kind, at + b))
            found += here
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_text(text: str) -> tuple[int, int, int, str, str, int]:
    base = base_spans(text)
    more = entropy_spans(text)
    kinds = [kind for _, kind, _ in base]
    return (
        kinds.count(0), kinds.count(1), kinds.count(2),
        hashlib.sha256(_joined(base).encode()).hexdigest(),
        _joined(sorted(base + more)), len(more),
    )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of base kinds, digest of their spans, all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, kind and end. Null and empty
    texts have no spans. Rows are scanned one by one where they lie: no shuffle, and repeated rows get
    repeated results. Other columns are not looked at. An empty table gives an empty result.
    """
    return map_texts(docs, RESULT, scan_text)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))

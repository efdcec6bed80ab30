"""Secret scan: fixed patterns, and runs of characters that look random.

What the patterns leave of a run of key characters is cut at equals signs before more
characters and around the words of paths. The pieces go through a battery of tests:

* The alphabet is the smallest of a few encodings that has all characters of the run.
* Against chance: a chi-squared test of uniform use of that alphabet, a runs test around
  its middle, and a test of serial correlation. A run is dropped if any of them says that
  a uniform source would hardly give it.
* Against ordinary text: the likelihood of the run under the uniform source is divided by
  that under the letters of its document outside all runs judged, on top of a fixed
  stock of ordinary letters, so that keys do not count as ordinary text. One over this ratio bounds the probability
  that ordinary letters give such a run, and falls with its length. The runs of a document
  are judged together by the Benjamini-Hochberg procedure, with weights by length.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sha256

# The patterns of the three kinds and their least lengths.
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

RUN = 20  # characters a run or piece has at least; every access and hex match lies inside one
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [_DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _DIGITS + _LOWER,
             _DIGITS + _UPPER, _DIGITS + _UPPER + _LOWER, _UPPER + _LOWER + _DIGITS + "+/",
             _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_"]
# Ordinary letters a document starts with: fixed counts of characters below 128, then others.
_STOCK = np.ones(129)
for _chars, _count in ((" ", 90), ("e", 55), ("t", 38), ("anios", 34), ("r", 32), ("hl", 22), ("d", 20), ("uc", 16), ("m", 13),
                       ("pgf", 10), ("bvw", 8), ("y", 7), ("kz", 4), ("jqx", 1), (".,\n", 5), ("-_/", 1),
                       (_UPPER, 0.6), (_DIGITS, 1)):
    for _c in _chars:
        _STOCK[ord(_c)] += _count
_IN_RUN = np.zeros(129, bool)
_IN_RUN[[ord(c) for c in _DIGITS + _LOWER + _UPPER + "+/_=-"]] = True
# A piece ends before an equals sign; up to two at the end of its run are padding.
_PIECE = re.compile(r"[^=]+(?:={1,2}(?![^=]))?")
# A part of a path that reads like words: three letters of one case in a row somewhere.
_SUBWORD = "(?>[A-Z]{2,}|[vV]?[0-9]{1,4}|[A-Za-z]?[a-z]*)"
_WORDS = re.compile(rf"(?=.*[a-z]{{3}}|.*[A-Z]{{3}}){_SUBWORD}(?:[-_+]{_SUBWORD})*+")


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(run: str) -> tuple[int, float]:
    """Size of the inferred alphabet, and the probability that a uniform source is as uneven."""
    alphabet = next((a for a in ENCODINGS if set(run) <= set(a)), None)
    if alphabet is None:
        return 0, 0.0
    size, n = len(alphabet), len(run)
    index = np.array([alphabet.index(c) for c in run])
    counts = np.bincount(index, minlength=size)
    square = size / n * float((counts.astype(float) ** 2).sum()) - n
    # Cube-root approximation to the upper tail of chi-squared.
    free = size - 1
    z = ((square / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)) if square > 0 else -9.0
    p_uniform = 0.5 * math.erfc(z / math.sqrt(2))
    upper = index >= size / 2
    a, b = int(upper.sum()), int(n - upper.sum())
    p_runs = 0.0
    if a and b:
        mean = 2 * a * b / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = _two_sided((1 + int((upper[1:] != upper[:-1]).sum()) - mean) / spread)
    centred = index - index.mean()
    power = float((centred ** 2).sum())
    p_serial = 0.0 if power == 0 else _two_sided((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n))
    return size, min(1.0, 3 * min(p_uniform, p_runs, p_serial))


def pieces(text: str, start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a run outside ``taken`` spans that are judged on their own."""
    rests, at = [], start
    for s, e in taken:
        if s < end and e > at:
            rests.append((at, s))
            at = e
    rests.append((at, end))
    out = []
    for a, b in rests:
        if b - a < RUN:
            continue
        for match in _PIECE.finditer(text, a, b):
            first, last = match.span()
            parts, place = [], first
            for part in match[0].split("/"):
                parts.append((place, place + len(part), bool(_WORDS.fullmatch(part.rstrip("=")))))
                place += len(part) + 1
            if not any(p[2] for p in parts):
                # A separator beside a span that was taken is no part of a key.
                first += first == a > start and text[first] in "/-_"
                out.append((first, last))
                continue
            held = None
            for s, e, word in [*parts, (last, last, True)]:
                if word:
                    if held:
                        out.append(held)
                    held = None
                elif e > s:
                    held = (held[0] if held else s, e)
            # A key made of words only is one of the parts.
            out += [(s, e) for s, e, word in parts if word]
    return [(s, e) for s, e in out if e - s >= RUN]


def _random_runs(runs: list[tuple[int, int]], taken: list[tuple[int, int]], text: str, points: np.ndarray,
                 alpha: float, uneven: float) -> list[tuple[int, int]]:
    if not runs:
        return []
    outside = np.ones(len(points), bool)
    for start, end in [*runs, *taken]:
        outside[start:end] = False
    letters = np.bincount(np.minimum(points[outside], 128), minlength=129) + _STOCK
    log_text = np.log(letters / letters.sum())
    judged = []
    for start, end in runs:
        body = text[start:end].rstrip("=")
        size, chance = battery(body)
        if not size:
            judged.append((1.0, end - start, False, start, end))
            continue
        ratio = -len(body) * math.log(size) - float(log_text[points[start:start + len(body)]].sum())
        judged.append((math.exp(-max(0.0, ratio)), len(body), chance >= uneven, start, end))
    # Long runs have more power, so they get more of the weight; the weights average 1.
    mean = sum(j[1] for j in judged) / len(judged)
    ranked = sorted((p * mean / n, start, end, fair) for p, n, fair, start, end in judged)
    cut = max((i for i, r in enumerate(ranked, 1) if r[0] <= alpha * i / len(ranked)), default=0)
    return [(start, end) for _, start, end, fair in ranked[:cut] if fair]


def scan(text: str, alpha: float = 1e-4, uneven: float = 1e-3) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text in code points, by start, then kind."""
    found = []
    folded = text.lower()
    if any(k in folded for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if len(text) < RUN:
        return sorted(found, key=lambda s: s[1])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = _IN_RUN[np.minimum(points, 128)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    runs = edges.reshape(-1, 2)
    runs = [tuple(r) for r in runs[runs[:, 1] - runs[:, 0] >= RUN].tolist()]
    for start, end in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, *m.span()) for m in pattern.finditer(text, start, end)
                      if m.end() - m.start() >= LEAST[kind]]
    taken = sorted((s, e) for _, s, e in found)
    free = [piece for r in runs for piece in pieces(text, *r, taken)]
    found += [("random", s, e) for s, e in _random_runs(free, taken, text, points, alpha, uneven)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced by a mark; overlapping spans become one."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    Null and empty texts have no spans. Repeated rows give a row each, a null id stays
    null, empty input gives no rows, other columns are not looked at. Of overlapping
    spans of different kinds all are listed; random runs only where no pattern matched.
    """
    def work(texts):
        rows = []
        for text in texts:
            spans = scan(text)
            base = [s for s in spans if s[0] != "random"]
            rows.append((*(sum(s[0] == k for s in base) for k in KINDS[:3]),
                         sha256(joined(base).encode()), joined(spans)))
        return rows

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, work, ["doc_id"], "doc_id bigint, n_assign bigint, n_access bigint,"
                                             " n_hex bigint, base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows with every secret in ``text_col`` replaced; a null text stays null."""
    from pyspark.sql.types import StringType

    import pyarrow as pa

    from .common import steps

    place = docs.columns.index(text_col)

    def run(batches):
        for batch in steps(batches, text_col):
            texts = [t if t is None else redacted(t, scan(t), mark) for t in batch.column(text_col).to_pylist()]
            yield batch.set_column(place, text_col, pa.array(texts, pa.string()))

    assert isinstance(docs.schema[text_col].dataType, StringType)
    return docs.mapInArrow(run, docs.schema)

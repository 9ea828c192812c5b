"""Secret scans with a battery of randomness tests.

Fixed patterns give base spans.  Besides, each long token is given an
encoding by its characters (hex, base32, base64 and the like) and tested for
what random data in that encoding would look like: uniform use of the
alphabet (chi-squared), runs above and below the alphabet's middle
(Wald-Wolfowitz), and lag-1 serial correlation.  The three p-values are
combined by Fisher's method; a token without digits must also change case as
random letters do.  Benjamini-Hochberg over a document's tokens, with the
levels of tokens shorter than the mean scaled down by their length, decides
which tokens are clearly not random.  No level passes FDR, whatever a token's
length and neighbours.  The rest, if long enough for the tests to have power,
are reported.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import as_text, map_texts, utf8

# The base patterns; letters of the keywords in either case.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
LOWER, UPPER, DIGIT = (re.compile(c) for c in ("[a-z]", "[A-Z]", "[0-9]"))

_D, _U, _L = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (          # the first whose alphabet has all of a token's characters
    ("hex", _D + "abcdef"), ("HEX", _D + "ABCDEF"), ("base32", _U + "234567"),
    ("base36", _D + _L), ("BASE36", _D + _U), ("base62", _D + _U + _L),
    ("base64", _U + _L + _D + "+/"), ("base64url", _U + _L + _D + "-_"),
)
ALPHABETS = tuple((name, {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS)
FDR = 0.05


def _normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_sf(x: float, k: float) -> float:
    """Wilson-Hilferty approximation of the upper tail."""
    if x <= 0:
        return 1.0
    v = 2 / (9 * k)
    return _normal_sf(((x / k) ** (1 / 3) - (1 - v)) / math.sqrt(v))


def encoding_of(token: str) -> tuple[str, dict[str, int]] | None:
    used = set(token)
    return next(((n, a) for n, a in ALPHABETS if used <= a.keys()), None)


def battery(token: str, alphabet: dict[str, int]) -> float:
    """Fisher's combination of the tests' p-values; small: not random."""
    n, size = len(token), len(alphabet)
    x = [alphabet[c] for c in token]
    chi2 = sum(v * v for v in Counter(x).values()) * size / n - n
    p = [_chi2_sf(chi2, size - 1)]
    high = [v >= size / 2 for v in x]
    a, b = sum(high), n - sum(high)
    if a and b:
        runs = 1 + sum(s != t for s, t in zip(high, high[1:]))
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p.append(2 * _normal_sf(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0)
    else:
        p.append(2.0 ** (1 - n))
    mu = sum(x) / n
    var = sum((v - mu) ** 2 for v in x)
    r = sum((s - mu) * (t - mu) for s, t in zip(x, x[1:])) / var if var else 1.0
    p.append(2 * _normal_sf(abs(r + 1 / n) * math.sqrt(n)))
    stat = -2 * sum(math.log(max(v, 1e-300)) for v in p)
    half = stat / 2     # chi-squared of 6 degrees: a closed form
    return math.exp(-half) * (1 + half + half * half / 2)


def least_length(size: int) -> int:
    """Length from which the tests have power: 80 bits in the encoding, and
    at least 20 characters."""
    return max(20, math.ceil(80 / math.log2(size)))


def is_mixed(token: str) -> bool:
    """Whether two of lower case, upper case and digits stand anywhere in the
    token: digits alone are a number, letters of one case may be a word."""
    return sum(c.search(token) is not None for c in (LOWER, UPPER, DIGIT)) > 1


def case_changes(token: str) -> float:
    """p-value of so few changes of case between neighbouring letters; small:
    words.  Random letters change in half of the places."""
    case = [c.isupper() for c in token if c.isalpha()]
    n = len(case) - 1
    changes = sum(a != b for a, b in zip(case, case[1:]))
    return _normal_sf((n - 1 - 2 * changes) / math.sqrt(n)) if n > 0 else 1.0


def tested_part(token: str) -> str:
    """The token, or where its characters are of no one encoding (``+`` or
    ``/`` beside ``-`` or ``_``) its longest part between the marks of either
    pair: a prefix or suffix was joined to it by the others."""
    if encoding_of(token):
        return token
    return max([*re.split("[-_]+", token), *re.split("[+/]+", token)], key=len)


def random_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, encoding, p) of the tokens that no test tells from random."""
    found = []
    for m in CANDIDATE.finditer(text):
        token = tested_part(m[0].rstrip("="))
        if is_mixed(token) and (kind := encoding_of(token)) and len(token) >= least_length(len(kind[1])):
            p = battery(token, kind[1])
            if not DIGIT.search(token):     # words joined by marks or by capitals
                p = min(1.0, 2 * min(p, case_changes(token)))
            found.append((m.start(), m.end(), kind[0], p, len(token)))
    # Benjamini-Hochberg: rejected tokens are not random; a longer token bears
    # a stricter test, so its level is larger in proportion to its length, but
    # never above FDR, however long it is beside the document's other tokens.
    mean = sum(f[4] for f in found) / len(found) if found else 1

    def scaled(f: tuple) -> float:
        return f[3] / min(1.0, f[4] / mean)

    found.sort(key=scaled)
    rejected = max((k for k, f in enumerate(found, 1) if scaled(f) <= FDR * k / len(found)), default=0)
    return [f[:4] for f in found[rejected:]]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; ends exclusive, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: the method adds random tokens that overlap
    no base span."""
    base = base_spans(text)
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    more = []
    for s, e, _, _ in random_spans(text):
        before = bisect_left(starts, e)     # base spans that start before its end; none may end after its start
        if not before or reach[before - 1] <= s:
            more.append((s, 3, e))
    return base, sorted(base + more)


def spans_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted_column(text_col: str = "text") -> Column:
    """The redacted text as a column, for projections that keep all others."""
    @F.pandas_udf("string")
    def redacted(texts):
        return texts.map(lambda raw: redact(t := as_text(raw), scan_text(t)[1]))

    return redacted(utf8(text_col))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base_spans and spans, both as ``kind:start:end`` joined
    by commas, counts of the base kinds, and the redacted text.

    NULL and empty texts have no spans and an empty redacted text; repeated
    rows are scanned each; further columns are ignored; no shuffle.
    """
    def make():
        def one(raw: bytes) -> tuple:
            text = as_text(raw)
            base, spans = scan_text(text)
            n = Counter(k for _, k, _ in base)
            return n[0], n[1], n[2], spans_string(base), spans_string(spans), redact(text, spans)
        return one

    return map_texts(docs, make, [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"),
                                  ("base_spans", "string"), ("spans", "string"), ("redacted", "string")],
                     id_col, text_col)

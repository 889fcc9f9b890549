"""Secret scans: base patterns, and sliding-window entropy over candidate strings.

Candidates are runs of characters that keys are made of. For each character class, a
window slides over the candidate's runs of that class; character counts and the sum
of c log2 c are updated as one character enters and one leaves, which gives the
window's Shannon entropy in constant time per step, and so are its odd neighbours:
letter pairs rare in words, lower case before upper case, a letter beside a digit.
Windows at or above the class's entropy with enough odd neighbours are joined into spans
of kind ``entropy``, so keys of letters only are found and words and numbers are not;
what the allow list matches takes no part in any window, and nothing else is spared.

Defined results: null texts count as empty and have no spans; whole texts are
scanned, row by row, without a shuffle; repeated rows each get their result; an empty table
gives an empty one; columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2
from string import ascii_letters, digits

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of
from sparkprep.session import ship_package

#: Base kinds in their order: pattern, group whose length counts, least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"(?<![0-9a-f])[0-9a-f]+"), 0, 24),
)
KINDS = {k: i for i, k in enumerate([*(b[0] for b in BASE), "entropy"])}


#: Letter pairs frequent in words; they are not odd.
PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de "
    "hi ri ro ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr "
    "ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh ir su "
    "id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke fr oo av ag if ap gr od "
    "bo sp rd do uc bu ei ov by rm ep tt oc fa ef cu rn sc gi da yo cr cl du ga qu ue ff ba ey ls va um pp "
    "ua up lu go ht ru ug ds lt pi rc rr eg au ck ew mu br bi pt ak pu ui rg ib tl ny ki rk ys ob mm fu ph "
    "og ms ye ud mb ip ub oi rl gu dr hr cc tw ft wn nu af hu nn eo vo rv nf xp gn sm fl iz ok nl my gl aw "
    "ju oa eq sy sl ps jo lf nv je nk kn gs dy hy ze ks xt bs ik dd ij oe sk zu".split())


def odd_pair(x: str, y: str) -> bool:
    """Whether ``y`` after ``x`` is unusual in words, names and numbers (other signs never are)."""
    if x.isalpha() and y.isalpha():
        if x.islower() and y.isupper():
            return True
        x, y = x.lower(), y.lower()
        return x + y not in PAIRS and abs(ord(x) - ord(y)) > 1
    return x.isalpha() and y.isdigit() or x.isdigit() and y.isalpha()


ODD = frozenset(x + y for x in ascii_letters + digits for y in ascii_letters + digits if odd_pair(x, y))


#: Units a bit in the windows' sums.
UNIT = 1 << 32


@dataclass(frozen=True)
class CharClass:
    """Runs of ``chars`` with a window of ``width`` at or above ``bits`` and with at least
    ``odd`` odd neighbours are suspicious."""

    chars: str
    width: int
    bits: float
    odd: int


@dataclass(frozen=True)
class Entropy:
    #: Per class, what all but some 2 to 6 in 100 windows of uniformly random characters reach;
    #: the lower of the class's own (hex) and its letters' (the others, so that either passes).
    classes: tuple[CharClass, ...] = (CharClass("0-9A-Fa-f", 16, 2.75, 3),
                                      CharClass("0-9a-z", 16, 3.03, 5),
                                      CharClass("0-9A-Z", 16, 3.03, 5),
                                      CharClass("0-9A-Za-z+/_-", 16, 3.32, 6))
    #: What looks random but is not secret. A match covers its own characters only: windows
    #: are looked for beside it, on both sides.
    allowed: tuple[str, ...] = (
        r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",  # UUIDs
        r"(?i:example|placeholder|sample|dummy|x{4,}|0123456789|abcdefgh)",
        r"(?<![0-9A-Za-z])\d{4}-\d\d-\d\d(?:[T_-][\d_-]{0,20}Z?)?(?![0-9A-Za-z])",               # dates
    )


class Scanner:
    def __init__(self, entropy: Entropy = Entropy()):
        chars = "".join(c.chars.rstrip("-") for c in entropy.classes)
        least = min(c.width for c in entropy.classes)
        self.candidate = re.compile(rf"(?<![{chars}-])[{chars}-]{{{least},}}")
        self.runs = [(re.compile(rf"[{c.chars}]{{{c.width},}}"), c) for c in entropy.classes]
        self.allowed = [re.compile(p) for p in entropy.allowed]
        top = max(c.width for c in entropy.classes) + 1
        #: n log2 n in whole units, so that a window's sum does not depend on those before it.
        self.weight = [0] + [round(n * log2(n) * UNIT) for n in range(1, top + 1)]

    def base(self, text: str) -> list[tuple[str, int, int]]:
        out = []
        for kind, pattern, group, least in BASE:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)
                    if m.end(group) - m.start(group) >= least]
        return out

    def windows(self, s: str, c: CharClass) -> Iterator[int]:
        """Starts of the windows of ``s`` that reach the class's entropy and odd neighbours."""
        counts: dict[str, int] = {}
        total, odd, weight, w = 0, 0, self.weight, c.width
        most = round((log2(w) - c.bits) * w * UNIT) + w  # rounding is less than a unit a character
        for i, x in enumerate(s):
            n = counts.get(x, 0)
            total += weight[n + 1] - weight[n]
            counts[x] = n + 1
            odd += s[i - 1:i + 1] in ODD
            if i >= w:
                y = s[i - w]
                n = counts[y]
                total += weight[n - 1] - weight[n]
                counts[y] = n - 1
                odd -= s[i - w:i - w + 2] in ODD
            if i >= w - 1 and odd >= c.odd and total <= most:
                yield i - w + 1

    def uncovered(self, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
        """The stretches of a candidate beside what the allow list covers."""
        for a, b in sorted(m.span() for p in self.allowed for m in p.finditer(text, start, end)):
            if a > start:
                yield start, a
            start = max(start, b)
        if end > start:
            yield start, end

    def entropy(self, text: str) -> list[tuple[str, int, int]]:
        found: list[list[int]] = []
        for m in self.candidate.finditer(text):
            for a, b in self.uncovered(text, *m.span()):
                for pattern, c in self.runs:
                    for r in pattern.finditer(text, a, b):
                        for at in self.windows(r[0], c):
                            found.append([r.start() + at, r.start() + at + c.width])
        spans: list[list[int]] = []
        for a, b in sorted(found):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        return [("entropy", a, b) for a, b in spans]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans (kind, start, end) in code points, by start, then kind."""
        return sorted(self.base(text) + self.entropy(text), key=lambda s: (s[1], KINDS[s[0]], s[2]))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                  T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            entropy: Entropy = Entropy()) -> DataFrame:
    """id and spans array<struct<kind, start, end>> of every document."""
    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(entropy)
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t or "")]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col)).mapInArrow(run, out)


def digests(scans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, base_sha256 and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return scans.select(id_col, count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))

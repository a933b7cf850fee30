"""Secret scan: candidates with their context, judged by a character convolutional network in numpy.

Three base kinds are found by pattern and always reported. The network judges every
candidate, base ones and further token-like strings, with the characters around it;
a further string above the threshold is reported as kind ``net``, and each base span
gets its probability in the operator's own output.

The network is trained here, on labelled findings that a seeded generator writes: keys,
tokens and passwords in the settings in which they leak, against digests, identifiers,
words, links and numbers in prose and code. Probabilities are calibrated on findings
that training never saw (Platt's method); the threshold is the highest that keeps the
asked-for recall on them. Both kinds of findings are generated, so how many leaks of a real corpus are found is not known.

The network sees ``INSIDE`` characters of a candidate at a time, with what stands around them. A longer
candidate is seen in several views that overlap by half, so that none of its characters is left out, and
counts as its most telling view.

Positions are code points, ends exclusive. Null and empty texts have no spans. A
document is a row: repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import mapped, pieces, read_table

KINDS = ("assign", "access", "hex")
NET = "net"


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


ASSIGN = re.compile("(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this is [0-9a-f]+ of at least 24
#: Further candidates: whole token-like runs, and whatever an assignment to a credential's name holds.
TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}")
KEYED = re.compile("(?:" + _either_case("pwd|auth|bearer|credential|private_?key|access_?key|client_?key") + r""")["']?[\x20:=]{1,3}["']?([A-Za-z0-9+/_.=~!@#$%^&*-]{8,})""")

BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
RECALL = 0.97


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind in their listed order."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def further_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidates that overlap no base span and not one another, leftmost first; a run that holds a credential's name goes behind its value."""
    keyed = [m.span(1) for m in KEYED.finditer(text)]
    runs, k = [], 0
    for m in TOKEN.finditer(text):
        while k < len(keyed) and keyed[k][1] <= m.start():
            k += 1
        if not (k < len(keyed) and m.start() < keyed[k][0] < m.end()):
            runs.append(m.span())
    found = sorted(runs + keyed)
    taken, out, last, k = sorted(x[:2] for x in base), [], 0, 0
    for lo, hi in found:
        while k < len(taken) and taken[k][1] <= lo:
            k += 1
        if lo >= last and not (k < len(taken) and taken[k][0] < hi):
            out.append((lo, hi))
            last = hi
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind in spans)


def views(text: str, lo: int, hi: int) -> np.ndarray:
    """Character classes of the candidate and its surroundings, a row for each part of it that the network sees at a time."""
    last = max(lo, hi - INSIDE)
    rows = []
    for at in [*range(lo, last, INSIDE // 2), last]:
        to = min(hi, at + INSIDE)
        rows.append(text[max(0, at - BEFORE) : at].rjust(BEFORE, "\0") + text[at:to].ljust(INSIDE, "\0") + text[to : to + AFTER].ljust(AFTER, "\0"))
    return np.frombuffer("".join(rows).encode("utf-32-le"), "<u4").clip(0, 127).astype(np.uint8).reshape(-1, WIDTH)


class CharCnn:
    """Embedding, one convolution with ReLU, maximum and mean over positions inside and outside the candidate, logistic output."""

    def __init__(self, seed: int = 11, embed: int = 12, filters: int = 32, width: int = 5):
        r = np.random.default_rng(seed)
        self.width, self.filters = width, filters
        self.p = {
            "e": r.normal(0, 0.5, (128, embed)),
            "w": r.normal(0, (2 / (width * (embed + 1))) ** 0.5, (width * (embed + 1), filters)),
            "b": np.zeros(filters),
            "v": r.normal(0, 0.1, 4 * filters),
            "c": np.zeros(1),
        }
        self.scale, self.shift = 1.0, 0.0
        self.threshold = 0.5
        where = np.zeros(WIDTH)
        where[BEFORE : BEFORE + INSIDE] = 1
        self.where = where
        steps = WIDTH - width + 1
        middle = where[width // 2 : width // 2 + steps] > 0
        self.zones = (np.flatnonzero(middle), np.flatnonzero(~middle))

    def _forward(self, x: np.ndarray, p: dict[str, np.ndarray] | None = None):
        p = p or self.p
        e = np.concatenate([p["e"][x], np.broadcast_to(self.where.astype(p["e"].dtype)[None, :, None], (*x.shape, 1))], axis=2)
        steps = x.shape[1] - self.width + 1
        columns = np.concatenate([e[:, k : k + steps] for k in range(self.width)], axis=2)
        z = columns @ p["w"] + p["b"]
        h = np.maximum(z, 0)
        parts, peaks = [], []
        for zone in self.zones:
            part = h[:, zone]
            peaks.append(zone[part.argmax(1)])
            parts += [part.max(1), part.mean(1)]
        pooled = np.concatenate(parts, axis=1)
        return columns, h, peaks, pooled, pooled @ p["v"] + p["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        """The logit of each view, in single precision."""
        p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return np.concatenate([self._forward(x[i : i + 512], p)[4] for i in range(0, len(x), 512)]).astype(float) if len(x) else np.zeros(0)

    def strongest(self, found: list[np.ndarray]) -> np.ndarray:
        """The logit of each candidate, given by its views: that of its most telling one. Equal views are computed once."""
        if not found:
            return np.zeros(0)
        distinct, back = np.unique(np.concatenate(found), axis=0, return_inverse=True)
        first = np.cumsum([0, *(len(x) for x in found[:-1])])
        return np.maximum.reduceat(self.logits(distinct)[back.ravel()], first)

    def probability(self, found: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.strongest(found) + self.shift)))

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        columns, h, peaks, pooled, logit = self._forward(x)
        d = (1 / (1 + np.exp(-logit)) - y) / len(y)
        g = {"v": pooled.T @ d, "c": np.array([d.sum()])}
        back, f = d[:, None] * self.p["v"][None, :], self.filters
        dh = np.zeros_like(h)
        rows, cols = np.arange(len(x))[:, None], np.arange(f)[None, :]
        for k, zone in enumerate(self.zones):
            dh[:, zone] += back[:, None, (2 * k + 1) * f : (2 * k + 2) * f] / len(zone)
            np.add.at(dh, (rows, peaks[k], cols), back[:, 2 * k * f : (2 * k + 1) * f])
        dz = dh * (h > 0)
        g["b"] = dz.sum((0, 1))
        g["w"] = columns.reshape(-1, columns.shape[2]).T @ dz.reshape(-1, f)
        dc = dz @ self.p["w"].T
        g["e"] = np.zeros_like(self.p["e"])
        size, steps = self.p["e"].shape[1], dz.shape[1]
        for k in range(self.width):
            np.add.at(g["e"], x[:, k : k + steps], dc[:, :, k * (size + 1) : k * (size + 1) + size])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 8, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> None:
        """Adam on the logistic loss."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(rounds):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                g = self._gradient(x[order[i : i + batch]], y[order[i : i + batch]])
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: list[np.ndarray], y: np.ndarray, recall: float) -> None:
        """Platt scaling by Newton steps with its smoothed targets, then the threshold."""
        z, n1, n0 = self.strongest(x), y.sum(), (1 - y).sum()
        target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * z + b)))
            w = np.maximum(p * (1 - p), 1e-9)
            g = np.array([((p - target) * z).sum(), (p - target).sum()])
            h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-9:
                break
        self.scale, self.shift = float(a), float(b)
        positive = np.sort(self.probability([v for v, secret in zip(x, y, strict=True) if secret]))
        self.threshold = float(positive[int((1 - recall) * len(positive))])


_ALNUM = string.ascii_letters + string.digits
_SYLLABLES = ["an", "er", "in", "th", "on", "re", "st", "en", "ti", "al", "que", "de", "la", "un", "ge", "ver", "ción", "ou", "é", "sch"]


def labelled_findings(n: int, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The views of n findings, and 1 for each that is a secret."""
    r = random.Random(seed)
    pick = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    word = lambda: "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))

    def secret() -> tuple[str, str]:
        value = r.choice([
            lambda: pick(_ALNUM, r.randint(20, 44)),
            lambda: pick(_ALNUM + "+/", r.choice([40, 43, 44, 64, 86])) + r.choice(["", "=", "=="]),
            lambda: r.choice(["sk_", "pk_", "ghp_", "xoxb-", "key-", "AIza"]) + pick(_ALNUM, r.randint(20, 36)),
            lambda: "eyJ" + pick(_ALNUM, r.randint(20, 50)),
            lambda: pick("0123456789abcdef", r.choice([32, 40, 64])),
            lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
            lambda: pick(_ALNUM + "_-", r.randint(18, 40)),
        ])()
        name = r.choice(["password", "secret", "token", "api_key", "apikey", "auth", "bearer", "client_key", "private_key", "access_key", "pwd", "credential", "Authorization", "aws"])
        return r.choice(["", word() + " "]) + r.choice([name, name.upper(), name.title()]) + r.choice([": ", "=", " = ", ' = "', "='", " ", ":", '": "']), value

    def plain() -> tuple[str, str]:
        return r.choice([
            lambda: (word() + " ", "".join(word() for _ in range(5)) + str(r.randint(0, 99))),
            lambda: (r.choice(["commit ", "sha1 ", "md5sum ", "etag ", "checksum: ", "version ", word() + " "]), pick("0123456789abcdef", r.choice([24, 32, 40]))),
            lambda: (r.choice(["id=", "uuid ", "order ", "ref. ", "item_", word() + " "]), f"{pick('0123456789abcdef', 8)}-{pick('0123456789abcdef', 4)}-4{pick('0123456789abcdef', 3)}-a{pick('0123456789abcdef', 3)}-{pick('0123456789abcdef', 12)}"),
            lambda: (r.choice(["https://", "www.", "/", "see "]), "/".join(word() for _ in range(4)) + "/" + str(r.randint(1, 10**6))),
            lambda: (word() + r.choice([" ", ", ", ": "]), pick(string.digits, r.randint(16, 24))),
            lambda: (word() + " ", "-".join([str(r.randint(1000, 9999)) for _ in range(4)])),
            lambda: (word() + " ", "_".join(word() for _ in range(4)) + "_" + str(r.randint(1, 99))),
            lambda: (word() + r.choice([" ", ". "]), "".join(r.choice(_SYLLABLES) for _ in range(9)) + pick(string.digits, 2)),
            lambda: (r.choice(["password: ", "token = ", "secret="]), r.choice(["changeme123example", "your_password_here1", "xxxxxxxxxxxxxxxx1", "example_token_0000"])),
            lambda: (word() + " ", pick("=-_", r.randint(16, 30)) + "1"),
            lambda: (r.choice(["phone ", "tel: ", "iban "]), "+" + pick(string.digits, 16)),
        ])()

    found, y = [], []
    for k in range(n):
        before, value = secret() if k % 2 else plain()
        before = "".join(word() + " " for _ in range(r.randint(0, 5))) + before
        after = r.choice(["", " ", ". ", '"', "'\n", ", "]) + "".join(" " + word() for _ in range(2))
        found.append(views(before + value + after, len(before), len(before) + len(value)))
        y.append(k % 2)
    return found, np.array(y, float)


@dataclass(frozen=True)
class Settings:
    findings: int = 6000
    recall: float = RECALL


@lru_cache(maxsize=2)
def train(settings: Settings = Settings()) -> CharCnn:
    """The network for the settings; the same on every run."""
    net = CharCnn()
    found, y = labelled_findings(settings.findings, 1)
    net.fit(np.concatenate(found), np.repeat(y, [len(x) for x in found]))  # every view of a finding has its label
    net.calibrate(*labelled_findings(settings.findings // 2, 2), settings.recall)
    return net


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """(key, spans): spans are structs of start, end, kind and the network's calibrated probability."""
    sent = docs.sparkSession.sparkContext.broadcast(train(settings))
    kind = "array<struct<start:int,stop:int,kind:string,probability:double>>"
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for part in pieces(batch):
                owner, spans, seen = [], [], []
                for k, x in enumerate(part.column(1).to_pylist()):
                    if x:
                        base = base_spans(x)
                        for lo, hi, name in [*base, *((lo, hi, NET) for lo, hi in further_spans(x, base))]:
                            owner.append(k)
                            spans.append((lo, hi, name))
                            seen.append(views(x, ASSIGN.match(x, lo).start(2) if name == "assign" else lo, hi))
                out: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for k, (lo, hi, name), p in zip(owner, spans, net.probability(seen).tolist(), strict=True):
                    if name != NET or p >= net.threshold:
                        out[k].append({"start": lo, "stop": hi, "kind": name, "probability": p})
                rank = (*KINDS, NET)
                for found in out:
                    found.sort(key=lambda s: (s["start"], rank.index(s["kind"])))
                yield pa.record_batch([part.column(0), pa.array(out, arrow)], names=["key", "spans"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(given, run, f"key long, spans {kind}").withColumnRenamed("key", key)


def digests(docs: DataFrame) -> DataFrame:
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != NET)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs).select("doc_id", *map(count, KINDS), F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """Counts and digest by the rule as it is written, for tests."""
    text = text or ""
    spans = [(m.start(), m.end(), 0) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    spans.sort(key=lambda s: (s[0], s[2]))
    n = [sum(s[2] == k for s in spans) for k in range(3)]
    return *n, hashlib.sha256(",".join(f"{KINDS[k]}:{lo}:{hi}" for lo, hi, k in spans).encode()).hexdigest()


QUERIES = {"op2_secret_scan": query}

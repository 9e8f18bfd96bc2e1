"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams for the rest.

A url's host and path are cut into character n-grams of three to five characters, with marks at their ends and with the
part they come from, hashed into ``WIDTH`` features (present or not, scaled to length one).  The regression is trained
in numpy on the small labelled table in ``labelled_urls`` by full gradient steps with an L2 penalty; it is a vector of
``WIDTH`` weights, the same in every task.

Rules come first: a rule is a host and a path, fits its host and all subdomains if the url's path starts with its path,
and the longest rule that fits decides.

Pages are independent, so one pass over the table does it, without a shuffle; repeated hosts are hashed once per batch.

Rules for odd rows: the host runs from behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; the path from there to ``?``, ``#`` or the end; a null url, or one without ``://``, has neither and is judged
by the regression like any other; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.labelled_urls import ALLOWED, BLOCKED

WIDTH = 1 << 14
SIZES = (3, 4, 5)
PENALTY = 1e-3
ROUNDS = 400
THRESHOLD = 0.5  # blocked from this probability on

#: The rules, with what each says.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PARTS = re.compile(r"([^/?#]*)([^?#]*)")


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    host, path = _PARTS.match(url, url.index("://") + 3).groups()
    return host.translate(_UPPER), path


def rule_for(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple[str | None, str | None]:
    """The longest rule that fits and its verdict; ``rules``: by host, (path, rule, verdict)."""
    best: tuple[str | None, str | None] = (None, None)
    at = 0
    while True:
        for start, rule, verdict in rules.get(host[at:], ()):
            if path.startswith(start) and (best[0] is None or len(rule) > len(best[0])):
                best = rule, verdict
        at = host.find(".", at) + 1
        if not at:
            return best


def by_host(rules: tuple[tuple[str, str], ...]) -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        out.setdefault(host, []).append((slash + path, rule, verdict))
    return out


def grams(part: str, mark: str) -> set[int]:
    """Feature numbers of a host or path."""
    data = f"^{part}$"
    return {zlib.crc32((mark + data[k : k + n]).encode("utf-8", "surrogatepass")) % WIDTH for n in SIZES for k in range(len(data) - n + 1)}


@functools.cache
def trained() -> tuple[np.ndarray, float]:
    """Weights and bias from the labelled table."""
    urls = [(u, 0.0) for u in (*ALLOWED, "")] + [(u, 1.0) for u in BLOCKED]
    x = np.zeros((len(urls), WIDTH))
    for k, (url, _) in enumerate(urls):
        host, path = host_and_path(url)
        at = list(grams(host, "h") | grams(path, "p"))
        x[k, at] = 1 / np.sqrt(max(1, len(at)))
    y = np.array([label for _, label in urls])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())  # both labels weigh the same
    w, b = np.zeros(WIDTH), 0.0
    for _ in range(ROUNDS):
        apart = share * (1 / (1 + np.exp(-(x @ w + b))) - y)
        w -= 20 * (x.T @ apart + PENALTY * w)
        b -= 2 * apart.sum()
    return w, b


class Judge:
    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.rules = by_host(rules)
        self.hosts: dict[str, tuple[int, float, frozenset]] = {}

    def probability(self, host: str, path: str) -> float:
        w, b = trained()
        if host not in self.hosts:
            own = grams(host, "h")
            self.hosts[host] = len(own), float(w[list(own)].sum()), frozenset(own)
        n, total, own = self.hosts[host]
        more = grams(path, "p") - own
        total, n = total + float(w[list(more)].sum()), n + len(more)
        return float(1 / (1 + np.exp(-(total / np.sqrt(max(1, n)) + b))))

    def __call__(self, url: str | None) -> tuple:
        host, path = host_and_path(url)
        rule, verdict = rule_for(host, path, self.rules)
        p = self.probability(host, path)
        return host, path, rule, verdict or ("block" if p >= THRESHOLD else "allow"), p


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``): page_id, host, path, rule, verdict, and the regression's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = Judge(rules)
            found = [one(url) for url in batch.column(1).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([f[4] for f in found], pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "blocked_probability"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string, blocked_probability double")

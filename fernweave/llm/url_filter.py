"""URL filters: many glob rules matched at once by multiword Shift-And masks.

A URL is brought to the canonical form ``.host`` + separator + ``path``: the
host stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the
end, with A-Z lower-cased; the path goes on to ``?``, ``#`` or the end. The
separator is the byte 0xFF, which UTF-8 never holds.

Every rule is a glob over the canonical form (``*`` any run of bytes, ``?`` one
byte, anything else itself, anchored at both ends). All globs are laid end to
end in one bit vector of 64-bit words. A bit stands for a pattern position;
per byte, the whole vector is shifted, masked by the byte's row and joined with
the self-loops of ``*`` positions (Navarro and Raffinot's extended Shift-And).
A batch of URLs is a matrix of words, so one step advances every pattern on
every URL of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fernweave.llm.common import mapped, table

SEPARATOR = 0xFF


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> bytes:
        return b"*." + escaped(self.host) + bytes([SEPARATOR]) + escaped(self.path) + b"*"


def escaped(text: str) -> bytes:
    return text.encode().replace(b"\\", b"\\\\").replace(b"*", b"\\*").replace(b"?", b"\\?")


def canonical(url: str | None) -> tuple[str, str]:
    """Host and path; both empty for null or a URL without ``://``."""
    if url is None or (start := url.find("://")) < 0:
        return "", ""
    rest = url[start + 3 :]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in host), path


class GlobAutomaton:
    """Shift-And masks of many globs; ``match`` runs them over a batch."""

    def __init__(self, globs: list[bytes]):
        positions: list[int] = []  # the byte at each position, -1 for any
        loops: list[int] = []  # positions whose bit stays set: a star follows them
        starts: list[int] = []
        ends: list[int] = []
        for glob in globs:
            # Position 0 of each pattern is its start state, set before the first byte.
            starts.append(len(positions))
            positions.append(-2)
            i = 0
            while i < len(glob):
                c = glob[i]
                if c == ord("*"):
                    loops.append(len(positions) - 1)
                elif c == ord("\\") and i + 1 < len(glob):
                    i += 1
                    positions.append(glob[i])
                else:
                    positions.append(-1 if c == ord("?") else c)
                i += 1
            ends.append(len(positions) - 1)
        self.words = max(1, (len(positions) + 63) // 64)
        bits = np.zeros((256, self.words * 64), bool)
        for at, byte in enumerate(positions):
            if byte == -1:
                bits[:, at] = True
            elif byte >= 0:
                bits[byte, at] = True
        self.masks = self._packed(bits)
        self.loops = self._packed(self._row(loops))[0]
        self.starts = self._packed(self._row(starts))[0]
        self.ends = ends

    def _row(self, at: list[int]) -> np.ndarray:
        row = np.zeros((1, self.words * 64), bool)
        row[0, at] = True
        return row

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text, a column for each glob: whether it matches the whole text."""
        n = len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-lengths, kind="stable")  # the longest first: those still running are a prefix
        ordered = lengths[order]
        offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        data = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        state = np.repeat(self.starts[None, :], n, axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for i in range(int(ordered[0]) if n else 0):
            live = int(np.searchsorted(-ordered, -i, side="left"))
            s = state[:live]
            shifted = s << one
            shifted[:, 1:] |= s[:, :-1] >> top
            state[:live] = (shifted & self.masks[data[offsets[:live] + i]]) | (s & self.loops)
        hit = np.empty((n, len(self.ends)), bool)
        for k, end in enumerate(self.ends):
            hit[order, k] = (state[:, end // 64] >> np.uint64(end % 64)) & one
        return hit


class UrlFilter:
    """Host-and-path rules, the longest of those that fit deciding, before plain block globs.

    Of equally long rules that fit, the first listed decides. ``block_globs``
    are globs over ``.host`` and the path, parted by a space in the glob's text.
    """

    #: URLs of one run of the automaton; with the words of a state this bounds memory.
    CHUNK = 4096

    def __init__(self, rules: list[Rule], block_globs: list[str] = ()):
        self.rules = sorted(rules, key=lambda r: -len(r.name))
        self.n_rules = len(self.rules)
        self.automaton = GlobAutomaton(
            [r.glob for r in self.rules] + [g.encode().replace(b" ", bytes([SEPARATOR])) for g in block_globs]
        )

    def judge(self, urls: list[str | None]) -> list[tuple[str, str, str | None, str]]:
        """(host, path, rule or None, verdict) of each URL."""
        out = []
        for at in range(0, len(urls), self.CHUNK):
            parts = [canonical(u) for u in urls[at : at + self.CHUNK]]
            hits = self.automaton.match([b"." + h.encode() + bytes([SEPARATOR]) + p.encode() for h, p in parts])
            ruled, first = hits[:, : self.n_rules].any(axis=1), hits[:, : self.n_rules].argmax(axis=1) if self.n_rules else None
            blocked = hits[:, self.n_rules :].any(axis=1)
            for i, (host, path) in enumerate(parts):
                if ruled[i]:
                    rule = self.rules[first[i]]
                    out.append((host, path, rule.name, rule.verdict))
                else:
                    out.append((host, path, None, "block" if blocked[i] else "allow"))
        return out


ADDED = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


def filter_urls(df: DataFrame, url: str, rules: list[Rule], block_globs: list[str] = (), keep: list[str] | None = None) -> DataFrame:
    """Append host, path, rule and verdict to each row, in one pass without a shuffle.

    A null URL, or one without ``://``, has an empty host and path, fits no rule
    and is judged by the globs alone. Rows may repeat; each is judged. An empty
    table gives an empty one. Other columns pass through, save those named like
    the added ones.
    """
    automaton = UrlFilter(rules, block_globs)

    def run(urls: list[str | None]) -> list[pa.Array]:
        columns = zip(*automaton.judge(urls), strict=True) if urls else ([], [], [], [])
        return [pa.array(c, pa.string()) for c in columns]

    return mapped(df, [url], run, ADDED, keep)


#: Fixed values of the contract: rules of host, path and verdict.
BASE_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

#: Hosts that sell or track, as globs over ``.host`` and path parted by a space.
BLOCK_GLOBS = ["*casino* *", "*cheap-pills* *", "*free-bets* *", "*ads-track* *", "* */wp-login.php*", "* *.exe"]


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, "url", BASE_RULES, BLOCK_GLOBS, ["page_id"])


ORACLE = r"""
WITH p AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
                       ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0) END AS rest
  FROM pages
), q AS (
  SELECT page_id,
         translate(CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM p
), r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM q
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN host LIKE '%casino%' OR host LIKE '%cheap-pills%' OR host LIKE '%free-bets%' OR host LIKE '%ads-track%'
      OR path LIKE '%/wp-login.php%' OR path LIKE '%.exe' THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {"op6_url_filter": ORACLE}

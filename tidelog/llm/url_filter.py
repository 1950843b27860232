"""URL allow and block rules: a broadcast trie over reversed host labels and path segments.

The rule list is a parameter of bounded size (``MAX_RULES``), so the trie may be broadcast whatever the table's size.
A rule fits its host and every subdomain of it when the url's path starts with the rule's path; among the rules that
fit, the one with the longest host wins, then the longest path; between equal allow and block entries block wins.
Null urls and urls without ``://`` have an empty host and path, and fit no rule; they get ``default``.
Urls of any length are judged whole; rows that repeat an id keep a row each; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_RULES = 1_000_000
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) of a url as written; ports and user names stay part of the host."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, tail = rest[:end], rest[end:]
    cut = min((i for c in "?#" if (i := tail.find(c)) >= 0), default=len(tail))
    return host.translate(_LOWER), tail[:cut]


class RuleTrie:
    """Hosts by label from the last, then paths by segment; the last segment of a rule's path may be a part of one."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.hosts: dict = {}
        for count, (action, host, path) in enumerate(rules, 1):
            if count > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules")
            if action not in ("allow", "block"):
                raise ValueError(f"unknown action {action!r}")
            host = host.translate(_LOWER)
            node = self.hosts
            for label in reversed(host.split(".")):
                node = node.setdefault("." + label, {})
            *whole, last = path.split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            ends = node.setdefault("ends", {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host + path, action)
        self._order(self.hosts)

    def _order(self, node: dict) -> None:
        for key, child in node.items():
            if key == "ends":
                node[key] = dict(sorted(child.items(), key=lambda e: -len(e[0])))
            else:
                self._order(child)

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        segments, best = path.split("/"), None
        for depth, segment in enumerate(segments):
            rest = segment if depth == len(segments) - 1 else segment + "/"
            for last, found in node.get("ends", {}).items():
                if rest.startswith(last):
                    best = found
                    break
            node = node.get("/" + segment) if depth < len(segments) - 1 else None
            if node is None:
                break
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits, or None."""
        node, best = self.hosts, None
        for label in reversed(host.split(".")):
            node = node.get("." + label)
            if node is None:
                break
            if "paths" in node:
                best = self._path(node["paths"], path) or best
        return best


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", key: str = "page_id", default: str = "allow") -> DataFrame:
    """key, host, path, rule, verdict for every row of ``pages``. No shuffle: one pass over two columns."""
    RuleTrie(rules)  # checks the rules here, before any task does
    shared = pages.sparkSession.sparkContext.broadcast(list(rules))
    kind = pages.schema[key].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RuleTrie(shared.value)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [trie.find(h, p) if h else None for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(x, pa.string()) for x in ([h for h, _ in parts], [p for _, p in parts], [f and f[0] for f in found], [f[1] if f else default for f in found])],
                [key, "host", "path", "rule", "verdict"],
            )

    return pages.select(key, url).mapInArrow(judge, f"`{key}` {kind}, host string, path string, rule string, verdict string")

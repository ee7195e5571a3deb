"""URL filters: a trie over reversed host labels and path segments, broadcast, longest match first.

A rule is ``host/path``. It fits its host and all subdomains of it when the path of the URL starts with
the rule's path. Among the rules that fit, the longest decides: the one with most host labels, then
with the longest path. An equal rule given twice must carry one verdict. A URL that no rule fits gets
the default verdict.

Defined cases: a null URL, or one without ``://``, has an empty host and path, which no rule fits; an
empty table gives an empty result; repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_UPPER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: Rules are broadcast; more of them, or longer ones in sum, are refused.
MAX_RULES, MAX_RULE_CHARS = 1_000_000, 64_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z only) and path."""
    found = _URL.search(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


class UrlTrie:
    """Nodes are dicts: host labels from the last to the first, then ``/`` and the path by segments.

    A path that ends inside a segment keeps that last part among the ``partial`` starts of its node,
    by length, so that one look-up for each length finds the longest that the segment starts with.
    """

    def __init__(self, rules: list[tuple[str, str]]):
        if len(rules) > MAX_RULES or sum(len(rule) for rule, _ in rules) > MAX_RULE_CHARS:
            raise ValueError("too many rules to broadcast")
        self.root: dict = {}
        for rule, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of {rule!r}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, last = (slash + path).split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            starts = node.setdefault("partial", {}).setdefault(len(last), {})
            if starts.setdefault(last, (rule, verdict)) != (rule, verdict):
                raise ValueError(f"{rule!r} is both allowed and blocked")

    def _path(self, node: dict, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/"):
            for length in sorted(node.get("partial", ()), reverse=True):
                if found := node["partial"][length].get(segment[:length]) if length <= len(segment) else None:
                    best = found
                    break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that decides, with its verdict."""
        best, node = None, self.root
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node and (found := self._path(node["paths"], path)):
                best = found
        return best


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: id, host, path, the deciding rule (null: none) and the verdict."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(UrlTrie(rules))

    def run(batches):
        trie = shared.value
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [trie.match(*p) for p in parts]
            columns = [[p[0] for p in parts], [p[1] for p in parts], [f and f[0] for f in found], [f[1] if f else default for f in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in columns]], names=[id, "host", "path", "rule", "verdict"])

    return pages.select(F.col(id), F.col(url).cast("string").alias("url")).mapInArrow(run, f"`{id}` {pages.schema[id].dataType.simpleString()}, host string, path string, rule string, verdict string")

"""URL allow and block lists as a broadcast trie.

Rules are (verdict, entry) pairs; an entry is a host, then a path that starts
with a slash, e.g. ``("block", "example.org/es/")``. The trie descends the
host's labels from the right, then the path's segments from the left; the last
piece of a rule's path is a prefix of the segment that follows, so
``example.org/en/1`` also fits ``/en/12``. The deepest host wins, then the
longest path, whichever list the entry is on; with one entry on both lists,
block wins. What no entry fits gets ``default``.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and gets ``default``. Rows are judged one by one, so repeated rows
and null ids come through unchanged; an empty table gives an empty result.
Input columns other than the id and the URL are not carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from citystream.llm.common import map_rows
from citystream.session import prepare

#: The trie is broadcast; more rules than this are refused (about 1 kB each as Python objects).
MAX_RULES = 200_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    m = _URL.search(url) if url is not None else None
    return (m[1].translate(_ASCII), m[2]) if m else ("", "")


class Trie:
    """Host node: ``(children by label, path node)``; path node:
    ``(children by segment, {tail: (verdict, entry)})``."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: tuple[dict, list] = ({}, [None])
        for n, (verdict, entry) in enumerate(rules):
            if n >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict of {entry!r} must be allow or block")
            host, slash, path = entry.partition("/")
            node = self.root
            for label in reversed(host.translate(_ASCII).split(".")):
                node = node[0].setdefault(label, ({}, [None]))
            if node[1][0] is None:
                node[1][0] = ({}, {})
            at = node[1][0]
            *whole, tail = (slash + path).split("/")
            for segment in whole:
                at = at[0].setdefault(segment, ({}, {}))
            if at[1].get(tail, ("allow",))[0] != "block":
                at[1][tail] = (verdict, entry)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, entry) of the longest match."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1][0] is not None:
                best = self._path(node[1][0], path) or best
        return best

    @staticmethod
    def _path(at: tuple[dict, dict], path: str) -> tuple[str, str] | None:
        best, start = None, 0
        while at is not None:
            fits = [t for t in at[1] if path.startswith(t, start)]
            if fits:
                best = at[1][max(fits, key=len)]
            end = path.find("/", start)
            if end < 0:
                break
            at, start = at[0].get(path[start:end]), end + 1
        return best


def judge_urls(df: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``df``."""
    # Plain dicts: broadcasts are unpickled by reference, which a class would need the package for.
    root = prepare(df.sparkSession).sparkContext.broadcast(Trie(rules).root)

    def make():
        trie = Trie(())
        trie.root = root.value
        find = trie.find

        def judge(urls: list[str | None]) -> dict:
            parts = [split_url(u) for u in urls]
            found = [find(h, p) if h else None for h, p in parts]
            return {"host": [h for h, _ in parts], "path": [p for _, p in parts],
                    "rule": [f[1] if f else None for f in found], "verdict": [f[0] if f else default for f in found]}

        return judge

    return map_rows(df, [id_col], url_col, make, "host string, path string, rule string, verdict string")

"""HTML pages to rows: one streaming parser pass, everything after it is relational."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = {"title", "h1", "h2", "h3", "h4", "p", "li", "td", "th", "a", "div"}


class _Elements(HTMLParser):
    """(tag, href, text, position) of block and link elements; broken markup never fails."""

    def __init__(self) -> None:
        super().__init__()
        self.open: list[list] = []
        self.texts: list[str] = []
        self.rows: list[tuple[str, str | None, str, int]] = []
        self.muted = 0

    def handle_starttag(self, tag, attrs):
        self.muted += tag in ("script", "style")
        if tag in BLOCKS:
            self.open.append([tag, dict(attrs).get("href"), len(self.texts), len(self.rows) + len(self.open)])

    def handle_endtag(self, tag):
        self.muted -= tag in ("script", "style") and self.muted > 0
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for name, href, begun, at in reversed(self.open[k:]):
                    self.rows.append((name, href, " ".join("".join(self.texts[begun:]).split()), at))
                del self.open[k:]
                break

    def handle_data(self, data):
        if not self.muted and self.open:
            self.texts.append(data)  # once; an element's text is the stretch since its start


def page_elements(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, tag, href, content, position) for every block and link of each page; null pages have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"k": [], "tag": [], "href": [], "content": [], "position": []}
            for k, h in zip(*(c.to_pylist() for c in b.columns)):
                parser = _Elements()
                parser.feed(h or "")
                parser.close()
                for tag, href, content, at in sorted(parser.rows, key=lambda r: r[3]):
                    for name, v in zip(out, (k, tag, href, content, at)):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["k"], b.column(0).type), *(pa.array(out[c], pa.string()) for c in ("tag", "href", "content")), pa.array(out["position"], pa.int32())], names=[key, "tag", "href", "content", "position"])

    src = pages.select(key, html)
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, tag string, href string, content string, position int")

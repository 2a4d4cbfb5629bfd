"""Links of pages, read by the standard HTML parser in one Arrow pass."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHORS = "src string, href string, dst string"


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: dict[str, None] = {}

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found.update((value, None) for name, value in attrs if name == "href" and value)


def read_anchors(page: str) -> list[str]:
    """Distinct href values in page order, references decoded."""
    reader = _Anchors()
    reader.feed(page)
    return list(reader.found)


def joined(base: str | None, href: str) -> str:
    """The absolute address; empty for what can't be one."""
    try:
        return urljoin(base or "", href)
    except ValueError:
        return ""


def anchors_of(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per page and distinct href: src, href, dst."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(u, h, joined(u, h)) for u, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for h in read_anchors(page or "")]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["src", "href", "dst"])

    return pages.select(F.col(url), F.col(html)).mapInArrow(work, ANCHORS)

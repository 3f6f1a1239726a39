"""Site templates learned from the corpus: which lines of pages are furniture.

Lines are compared by their form: case and spaces folded, digits and addresses
masked. What a form is follows from where it stands on all pages that show it.
Each page anchors itself: its own title marks where the body begins, and the
last line that lies in a dense region (text-to-tag ratio, smoothed, above the
page's threshold) and recurs nowhere marks where it ends at the earliest. A form that
mostly stands outside of that stretch is furniture; so is a recurring line that
is mostly separators, and one whose only changing part is a date. A furniture
line that is followed by other lines than furniture where no body can be heads a
block of teasers. Evidence is absolute (a lower bound of the share), so the
rule is the same for ten pages and for a hundred million.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.operators.skew import salted_join
from loomgraph.session import cut, spread

#: A form recurs if at least so many lines have it.
RECURS = 5
#: Least share of a form's lines outside of bodies, or before the page's own heading, for furniture, and by how many
#: standard deviations the share must be passed (thousands of forms are tested).
OUTSIDE, AHEAD, SIGMAS = 0.5, 0.08, 4
#: Greatest share of a sentence's or a label's lines inside of bodies for furniture.
INSIDE = 0.25
#: Least share of a furniture line's places outside of bodies that something other than furniture follows, for a teaser header.
HEADS = 0.5
FURNITURE_FLAG, HEADER_FLAG = 1, 2

DATED = re.compile(r"0+\W{1,3}0+\W{1,3}0+\W*$")
ADDRESS, DIGIT, DIGITS = re.compile(r"\S+@\S+"), re.compile(r"\d"), re.compile(r"\d+")
LABEL = re.compile(r"([^:]{2,24}): ")
SENTENCE = re.compile(r"[.!?…。！？।؟][\"'”’»)\]）」』]*$")
FEATURES = "p bigint, i int, h bigint, label boolean, dense boolean, head boolean, path boolean, linked boolean, dated boolean, sentence boolean"


def form_of(line: str) -> str:
    s = line.casefold()
    if "@" in s:
        s = ADDRESS.sub("@", s)
    return DIGITS.sub("0", s) if DIGIT.search(s) else s


def line_features(pages: DataFrame, text: str, title: str, read: Callable) -> DataFrame:
    """FEATURES of every line that is not blank; ``p`` numbers the page by its content.

    ``read(text, title)`` gives the lines, the same in lower case, their smoothed
    ratios, the threshold, the index of the heading that the title names (or
    None), the indexes of path lines and the number of separators of each line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = lru_cache(65_536)(lambda s: xxhash.xxh64_intdigest(s) - (1 << 63))
        schema = pa.schema([("p", pa.int64()), ("i", pa.int32()), ("h", pa.int64()), *((c, pa.bool_()) for c in ("label", "dense", "head", "path", "linked", "dated", "sentence"))])
        for batch in batches:
            rows: list[tuple] = []
            ids, texts, titles = batch.columns
            for p, t, name in zip(ids.to_pylist(), texts, titles):
                lines, folded, smooth, threshold, heading, paths, links = read(t.as_py(), name.as_py())
                for i, x in enumerate(folded):
                    if not x:
                        continue
                    form = form_of(x)
                    dated = len(form) < 60 and "0" in form and bool(DATED.search(form))
                    rows.append((p, i, digest(form), False, smooth[i] > threshold, i == heading, i in paths, links[i] > 1, dated, bool(SENTENCE.search(lines[i][-6:]))))
                    label = LABEL.match(form) if ": " in form else None
                    if label:
                        rows.append((p, i, digest("\0" + label.group(1)), True, False, i == heading, False, False, False, False))
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return pages.select("p", text, title).mapInArrow(run, FEATURES)


def _lower(count: Column, total: Column, share: float) -> Column:
    """count is more than ``share`` of total by SIGMAS standard deviations."""
    return count >= share * total + SIGMAS * F.sqrt(share * (1 - share) * total)


def furniture(lines: DataFrame) -> DataFrame:
    """(h, flag) of the forms that are furniture, HEADER_FLAG added for teaser headers."""
    recurring = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= RECURS).select("h", F.lit(True).alias("recurs"))
    marked = salted_join(lines, recurring, "h", "left")
    page = Window.partitionBy("p")
    unique = F.col("recurs").isNull() & ~F.col("label")
    zoned = marked.withColumn("start", F.min(F.when(F.col("head"), F.col("i"))).over(page)).withColumn("last", F.max(F.when(F.col("dense") & unique, F.col("i"))).over(page))
    ahead = F.col("i") < F.col("start")
    behind = (F.col("last") > F.col("start")) & (F.col("i") > F.col("last"))
    stats = zoned.filter("recurs AND start IS NOT NULL").groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ahead).alias("ahead"), F.count_if(ahead | behind).alias("outside"),
        F.count_if(~(ahead | behind) & (F.col("last") > F.col("start"))).alias("inside"), F.bool_or("head").alias("head"), F.bool_or("sentence").alias("sentence"),
        F.bool_and("dated").alias("dated"), F.bool_and("linked").alias("linked"), F.bool_or("label").alias("label"),
    )
    apart = _lower(F.col("outside"), F.col("n"), OUTSIDE) | _lower(F.col("ahead"), F.col("n"), AHEAD)
    rarely = F.col("inside") <= INSIDE * F.col("n")  # sentences and labels also stand in teasers: they must hardly ever stand in a body
    known = (apart & (rarely | ~(F.col("sentence") | F.col("label"))) & ~(F.col("label") & F.col("head"))) | F.col("dated") | F.col("linked")
    found = cut(stats.filter(known).select("h", "dated", "label"))
    # what follows furniture where no body can be
    seen = salted_join(zoned.filter(~F.col("label")), found.filter("NOT label").select("h", F.lit(True).alias("furniture"), F.col("dated").alias("old")), "h", "left")
    order = Window.partitionBy("p").orderBy("i")
    nxt = lambda c: F.lead(c).over(order)
    places = seen.select(
        "h", "furniture", "old", ahead.alias("ahead"), (ahead | behind).alias("out"),
        F.coalesce((nxt("i") == F.col("i") + 1) & nxt(F.col("furniture").isNull() | F.col("old")) & ~nxt("head") & ~nxt("path"), F.lit(False)).alias("goes_on"),
    )
    heads = places.filter("furniture AND out AND NOT old").groupBy("h").agg(F.count_if("goes_on").alias("c"), F.count(F.lit(1)).alias("n"))
    heads = heads.filter(_lower(F.col("c"), F.col("n"), HEADS)).select("h", F.lit(HEADER_FLAG).alias("more"))
    return found.join(heads, "h", "left").select("h", (F.lit(FURNITURE_FLAG) + F.coalesce("more", F.lit(0))).cast("int").alias("flag"))


def page_flags(pages: DataFrame, text: str, title: str, read: Callable) -> DataFrame:
    """(p, flags): for each page the lines that the corpus shows to be furniture, as (line index, flag)."""
    lines = cut(line_features(pages, text, title, read))
    flagged = salted_join(lines.select("h", "p", "i"), furniture(lines), "h", "inner")
    return flagged.groupBy("p").agg(F.collect_set(F.struct("i", "flag")).alias("flags"))


def with_flags(pages: DataFrame, key: str, text: str, title: str, read: Callable) -> DataFrame:
    """(key, text, title, flags) of the pages with a text; flags are null where no line is known."""
    numbered = pages.filter(F.col(f"`{text}`").isNotNull()).withColumn("p", F.xxhash64(f"`{key}`", f"`{text}`", f"`{title}`"))
    numbered = spread(numbered, "p")
    flags = page_flags(numbered, f"`{text}`", f"`{title}`", read)
    return numbered.join(flags, "p", "left").select(f"`{key}`", f"`{text}`", f"`{title}`", "flags")

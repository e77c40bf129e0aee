"""Main text by a site style tree.

The pages of a host are merged into one tree: nodes are element paths, a node's
presentations are the sequences of its children, its contents are the texts found
there.  With m different pages at a node,

* presentation importance is the entropy of its presentations, base m,
* a text on k of the m pages has content importance 1 - log k / log (m + doubt):
  ``doubt`` pages that nobody saw keep few pages from telling much,
* a block's importance is (1 - decay) * presentation of the element that holds it
  + decay * content.

Pages with equal text count once, so copies of an article are no template.  The
importance is weighed against what the element itself says: a block goes if
``weight * importance + (1 - weight) * prior`` is below ``limit``.  Text beside an
article, text of a page without one and text inside an article are so decided by
the tree, with a limit that is the lower the more the element speaks for the text.
Menus, adverts, forms and the like, which the element names as such, always go:
where their words differ on every page they carry no sign in the tree.

Scale: pages are parsed once and written; the tree is kept as grouped counts, with
partial sums, keyed by host, path and content, so a host with a third of all pages
is many keys.  Page texts are never gathered by host.

Defined cases: null or empty html gives empty text; a null url is a host of its
own; repeated rows are extracted each; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import array, sliced, written
from ledgerscreen.llm.dom import blocks, prior


@dataclass(frozen=True)
class Weights:
    decay: float = 0.9
    weight: float = 0.4
    limit: float = 0.5
    doubt: int = 5
    slice_bytes: int = 4_000_000


def number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


BLOCK = "path long, parent long, style long, words long, prior double, text string"


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str, slice_bytes: int) -> DataFrame:
    """(row, id, url, host, page, blocks): ``page`` is a hash of all its text."""
    src = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"),
                       pages[html_col].cast("string").alias("html"))
    kind = src.schema["id"].dataType.simpleString()
    struct = pa.struct([(n, pa.float64() if n == "prior" else pa.string() if n == "text" else pa.int64())
                        for n in (x.split()[0] for x in BLOCK.split(", "))])

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in sliced(batches, "html", slice_bytes):
            out, page, hosts = [], [], []
            for url, text in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
                found = blocks(text or "")
                main = any(x.main and not x.boiler for x in found)
                out.append([{"path": number(x.path), "parent": number(x.parent),
                             "style": number(" ".join(x.holder.children)), "words": number(x.text),
                             "prior": prior(x, main), "text": x.text} for x in found])
                page.append(number("\n".join(x.text for x in found if not x.boiler)))
                hosts.append(host_of(url))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + b.num_rows), pa.int64()), array(b.column("id")), array(b.column("url")),
                 pa.array(hosts), pa.array(page, pa.int64()), pa.array(out, pa.list_(struct))],
                names=["row", "id", "url", "host", "page", "blocks"])
            row += b.num_rows

    return src.mapInArrow(run, f"row long, id {kind}, url string, host string, page long, blocks array<struct<"
                          + ", ".join(x.replace(" ", ": ") for x in BLOCK.split(", ")) + ">>")


def importance(nodes: DataFrame, w: Weights) -> DataFrame:
    """(host, path, words, importance) of the texts whose importance is below 1,
    from (host, page, path, parent, style, words)."""
    seen = nodes.select("host", "path", "words", "parent", "page").distinct()
    shared = seen.groupBy("host", "path", "words", "parent").agg(F.count("*").alias("k")).where("k > 1")
    pages = nodes.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count("*").alias("m"))
    styles = (nodes.select("host", "parent", "style", "page").distinct().groupBy("host", "parent", "style")
              .agg(F.count("*").alias("c")).groupBy("host", "parent")
              .agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.log("c")).alias("cl")))
    looks = styles.select("host", "parent", F.when(F.col("t") > 1, (F.log("t") - F.col("cl") / F.col("t")) / F.log("t"))
                          .otherwise(1.0).alias("look"))
    content = 1 - F.log("k") / F.log(F.col("m") + w.doubt)
    return (shared.join(pages, ["host", "path"]).join(looks, ["host", "parent"])
            .select("host", "path", "words", "parent",
                    ((1 - w.decay) * F.col("look") + w.decay * content).alias("importance")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              w: Weights = Weights()) -> DataFrame:
    """(id, url, text) of every page."""
    tree = written(parsed(pages, id_col, url_col, html_col, w.slice_bytes), "dom")
    each = tree.select("row", "host", "page", F.posexplode("blocks").alias("at", "b")).select(
        "row", "host", "page", "at", "b.path", "b.parent", "b.style", "b.words", "b.prior")
    low = importance(each, w)
    score = w.weight * F.col("importance") + (1 - w.weight) * F.col("prior")
    gone = (each.where("prior > 0").join(low, ["host", "path", "words", "parent"]).where(score < w.limit)
            .groupBy("row").agg(F.collect_set("at").alias("gone")))
    gone = written(gone, "gone")         # its size is then known: while it is small, the texts are not shuffled
    # a block that the tree tells nothing about has importance 1
    limit = F.lit((w.limit - w.weight) / (1 - w.weight))
    joined = tree.join(gone, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.filter("blocks", lambda b, i: (b["prior"] >= limit) & ~F.array_contains(F.col("gone"), i))
    rest = F.filter("blocks", lambda b: b["prior"] >= limit)
    kept = F.when(F.size(stay) > 0, stay).otherwise(rest)      # a page is never emptied by its host's other pages
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return joined.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))

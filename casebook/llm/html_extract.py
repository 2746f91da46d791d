"""Main text of web pages by wrapper induction (operator 2).

1. Every page is parsed once into text blocks and a shape (its block elements, runs of equal siblings written once). Markup, scripts, and
   elements that name themselves as navigation, adverts, notices, comments and the like give no blocks.
2. The distinct shapes of each host are merged by simple tree matching into the host's template, in salted groups of about ``FOLD``
   shapes, then ``FAN`` partial templates at a time. No task sees a host's pages, only a bounded part of its distinct shapes.
3. Each distinct shape is aligned with its host's template, so blocks of different pages that stand in one
   template node share a slot.
4. A slot's text that recurs on at least half of the host's different pages (and on three) is constant: template, inside
   elements marked as the article or main part too. Headings there stay: every article of a host may have its "Abstract" and "Method".
5. A page's text is its varying blocks. On a page with a marked article or main part, the mark's hint decides about varying
   blocks outside of it: they are taken for teasers and the like. Marks of an article and of a main part count alike.

Defined results: a null or empty html gives an empty text; a null url is a host of its own; equal pages are
counted once in step 4 (a copied page doesn't turn into template); repeated rows give repeated results; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import dom
from casebook.llm._common import by_value, cut, lean
from casebook.llm.links import join_checked

by_value(__name__)

FOLD = 256  # distinct shapes of a host in a task's fold, about
FAN = 8  # partial templates merged at a time
LEAST_PAGES = 3
PARSED = "page_id bigint, url string, host string, shape string, nodes array<int>, levels array<int>, texts array<string>"
FOLDED = "host string, salt bigint, shape string"
HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower().rstrip(".") if m else ""


@lean
def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, shapes, sizes, nodes, levels, texts = [], [], [], [], [], []
        for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            shape, blocks = dom.parse(html or "")
            hosts.append(host_of(url))
            shapes.append(shape)
            sizes.append(len(blocks))
            for node, level, text in blocks:
                nodes.append(node)
                levels.append(level)
                texts.append(text)
        offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        lists = lambda x, kind: pa.ListArray.from_arrays(offsets, pa.array(x, kind))
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column(0), "url": batch.column(1), "host": pa.array(hosts, pa.string()),
            "shape": pa.array(shapes, pa.string()), "nodes": lists(nodes, pa.int32()),
            "levels": lists(levels, pa.int32()), "texts": lists(texts, pa.string())})


def _fold(key: tuple, shapes: pd.DataFrame) -> pd.DataFrame:
    """One template from shapes (or partial templates) of a host, in sorted order: reruns agree."""
    template = None
    for shape in sorted(shapes["shape"]):
        tree = dom.Tree.read(shape)
        template = tree if template is None else dom.merge(template, tree)
    return pd.DataFrame({"host": [key[0]], "salt": [key[1]], "shape": [template.write()]})


def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        trees = {t: dom.Tree.read(t) for t in set(batch["template"])}
        slots = [dom.align(trees[t], dom.Tree.read(s)) for t, s in zip(batch["template"], batch["shape"])]
        yield pd.DataFrame({"host": batch["host"], "shape": batch["shape"], "slots": slots})


def induce(parsed: DataFrame) -> DataFrame:
    """(host, shape, slots): the template's node for each node of each distinct shape of a host."""
    shapes = cut(parsed.select("host", "shape").distinct(), "html-shapes")
    sizes = cut(shapes.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / FOLD).alias("salts")), "html-sizes")
    most = sizes.agg(F.max("salts").alias("n")).first().n or 1
    parts = shapes.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("shape"), F.col("salts")))
    parts = parts.groupBy("host", "salt").applyInPandas(_fold, FOLDED)
    while most > 1:  # a tree of bounded merges
        parts = cut(parts.withColumn("salt", F.floor(F.col("salt") / FAN)), "html-parts")
        parts, most = parts.groupBy("host", "salt").applyInPandas(_fold, FOLDED), -(-most // FAN)
    templates = parts.drop("salt")
    paired = shapes.join(templates.withColumnRenamed("shape", "template"), "host")
    return paired.mapInPandas(_slots, "host string, shape string, slots array<int>")


def _keys():
    """For each block of a page the hash of its slot and text."""
    return F.transform(F.arrays_zip("nodes", "texts"), lambda b: F.xxhash64(F.get("slots", b["nodes"]), b["texts"]))


def constants(parsed: DataFrame, slots: DataFrame) -> DataFrame:
    """(host, constants): hashes of the slot texts that recur on half of a host's different pages."""
    page = parsed.where(F.size("texts") > 0).withColumn("page", F.xxhash64("texts"))
    seen = page.join(slots, ["host", "shape"]).select("host", "page", F.explode(F.array_distinct(_keys())).alias("constant")).distinct()
    pages = page.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = seen.groupBy("host", "constant").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_PAGES)
    often = counts.join(pages, "host").where("2 * n >= pages")
    # At most two texts for each text block of a page recur on half of the pages: the lists are short.
    return often.groupBy("host").agg(F.sort_array(F.collect_list("constant")).alias("constants"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, host) of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = cut(rows.mapInArrow(_parse, PARSED), "html-parsed")
    slots = cut(induce(parsed), "html-slots")
    constant = cut(constants(parsed, slots), "html-constants")
    wrappers = cut(slots.join(constant, "host"), "html-wrappers")  # one row for each shape of a host that has constants
    hosts, n = constant.select("host"), constant.count()
    marked = lambda i: (F.get("levels", i) > 0) | (F.array_max("levels") == 0)
    varying = lambda i: marked(i) & (
        (F.get("levels", i) == dom.HEADING) | ~F.array_contains("constants", F.get("keys", i)))
    # A host without constants has varying slots only: its pages need no slots.
    plain = join_checked(parsed, hosts, n, ["host"], "left_anti").select(
        "page_id", "url", "host", F.array_join(_at("texts", marked), "\n\n").alias("text"))
    wrapped = (
        join_checked(parsed, hosts, n, ["host"], "left_semi").join(wrappers, ["host", "shape"]).withColumn("keys", _keys())
        .select("page_id", "url", "host", F.array_join(_at("texts", varying), "\n\n").alias("text"))
    )
    return plain.unionByName(wrapped).withColumn("n_chars", F.char_length("text").cast("long")).select(
        "page_id", "url", "text", "n_chars", "host")


def _at(texts: str, wanted):
    places = F.when(F.size(texts) > 0, F.sequence(F.lit(0), F.size(texts) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(places, wanted), lambda i: F.get(texts, i))

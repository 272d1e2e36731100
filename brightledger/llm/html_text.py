"""The main text of web pages, by their own markup and by the difference from the page with the nearest URL.

A page is read once into text blocks. Elements that name themselves as something else than the article (navigation, header,
footer, aside, form, script, style, or a class, id or role of such a kind, such as an advert, a notice or comments) are
left out with their content. A name counts if all its parts say so (``comment-list``, ``cookieBanner``), not if one of them does (``social-sciences``, ``ad-hoc``);
and an element inside the article that holds more text than all the rest of it is kept, whatever its name. If the page marks its article (``<article>`` or ``<main>``, with text), the blocks inside are the text.

Otherwise the page is compared with its neighbours: the different pages of a host (equal ones count once, empty ones not) are put in
order of URL path, and the blocks of a page are aligned by a longest common subsequence with those of the page before and after it. What they
share is part of the site and is deleted. A neighbour may be a copy of the page and show nothing about the site; then pages two, three, four, eight, sixteen ...
places away are tried, to the end of the host. What the least similar of all these pages shares is the site's; a page that shares more than half of
the text that is left is a copy. So menus do not make a copy, however short the article is. Only where a host has two different pages
that share more than half, this cannot be told, and both are kept whole.

A marked article loses less, as articles may quote the same passage: only the blocks at its start or end that stand at the same place in
the marked articles of all the pages tried (copies left out), which must be four at least. A notice or newsletter line that a site
puts on each page is such a block.

Defined cases: null html counts as empty, and an empty page has an empty text; a null URL belongs to no host and has no neighbour; rows that
repeat are read alike; an empty table gives an empty result; unclosed elements end with the element around them.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_numbers
from .common import settle

# Element names of HTML and words that sites use to name parts of a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg object audio video canvas".split())
LEFT_OUT = frozenset("nav footer aside form menu dialog button select datalist label".split())
ARTICLE = frozenset("article main".split())
PARTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription "
    "comment comments reply replies discussion disqus share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager login signup search alert".split()
)
#: Words that only say where a part stands or what holds it.
NEUTRAL = frozenset(
    "site page main user users reader readers post posts article articles top bottom left right side upper lower global list lists section area box boxes bar bars block blocks "
    "container wrapper wrap inner outer content item items group thread links link button buttons column col row panel slot unit fixed sticky the js".split()
)
#: Pages that must agree before a line of a marked article is deleted.
LEAST_MET = 4
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

_tag = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)>", re.S
)
_named = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_part = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_host = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
_path = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def _says(names: list[str]) -> bool:
    """Whether one of the names consists of parts that are all known, one of them as something else than the article."""
    for name in names:
        parts = [p.lower() for p in _part.findall(name)]
        if any(p in PARTS for p in parts) and all(p in PARTS or p in NEUTRAL for p in parts):
            return True
    return False


def left_out(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element says that it is not part of the article."""
    if name in LEFT_OUT or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, *values in _named.findall(attributes):
        value = "".join(values)
        if key.lower() == "role":
            found = not ROLES.isdisjoint(value.lower().split())
        elif name in ARTICLE:
            found = not PARTS.isdisjoint(value.lower().split())
        else:
            found = _says(value.split()) or ("header" in value.lower().split() and not inside)
        if found:
            return True
    return False


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """The blocks of the article, those outside it, and whether the page marks an article."""
    kept: frozenset[int] = frozenset()
    while True:
        inner, outer, marked, gone = _blocks(page, kept)
        # An element that holds most of the article is no side matter. Each turn keeps one more, the largest.
        size, at = max(gone, default=(0, 0))
        if size <= sum(map(len, inner)) + sum(n for n, _ in gone) - size:
            return (inner, outer, True) if inner else ([], outer, False)
        kept |= {at}


def _blocks(page: str, kept: frozenset[int]) -> tuple[list[str], list[str], bool, list[tuple[int, int]]]:
    """Blocks inside and outside, whether there is an article, and of each element that its name leaves out of the article: characters of text, place in the page."""
    inner, outer, held, depth, marked, at = [], [], [], 0, False, 0
    skip, nested = "", 0  # the element that is left out, and how often it is open within itself
    began, gone, lost = -1, [], 0  # where it begins if its name alone leaves it out, and its text so far

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            (inner if depth else outer).append(text)

    def leave() -> None:
        nonlocal began, lost
        if began >= 0:
            gone.append((lost, began))
        began, lost = -1, 0

    while m := _tag.search(page, at):
        if not skip:
            held.append(page[at : m.start()])
        elif began >= 0:
            lost += len("".join(page[at : m.start()].split()))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ends, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not ends:
            if not attributes.endswith("/"):
                over = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = over.end() if over else len(page)
            continue
        if skip:
            if name == skip:
                nested += -1 if ends else 1
            around = skip not in ARTICLE and name in ARTICLE and (ends and depth or not ends and not left_out(name, attributes, bool(depth)))
            if nested <= 0 or around or skip == "p" and name in BLOCKS:
                skip = ""
                leave()
                if nested <= 0 and not around:
                    if name != "p" or ends:
                        continue
            else:
                continue
        if name in BLOCKS:
            close()
        elif name == "br":
            held.append(" ")
        if ends:
            depth -= name in ARTICLE and depth > 0
        elif name not in VOID and not attributes.endswith("/"):
            if m.start() not in kept and left_out(name, attributes, bool(depth)):
                close()
                skip, nested = name, 1
                began, lost = (m.start() if depth and not left_out(name, "", True) else -1), 0
            elif name in ARTICLE:
                depth, marked = depth + 1, True
    if not skip:
        held.append(page[at:])
        close()
    elif began >= 0:
        lost += len("".join(page[at:].split()))
        leave()
    return inner, outer, marked, gone


def shared(a: list[int], b: list[int]) -> np.ndarray:
    """Which items of a lie on a longest common subsequence with b. The k-th of equal items can meet the k-th only."""

    def numbered(x: list[int]) -> list[tuple[int, int]]:
        seen: dict[int, int] = {}
        out = []
        for v in x:
            seen[v] = seen.get(v, -1) + 1
            out.append((v, seen[v]))
        return out

    place = {v: i for i, v in enumerate(numbered(b))}
    where = [(i, place[v]) for i, v in enumerate(numbered(a)) if v in place]
    # Longest increasing subsequence of the places.
    tops, last, back = [], [], [-1] * len(where)
    for k, (_, j) in enumerate(where):
        t = bisect_left(tops, j)
        if t == len(tops):
            tops.append(j)
            last.append(k)
        else:
            tops[t], last[t] = j, k
        back[k] = last[t - 1] if t else -1
    keep = np.zeros(len(a), bool)
    k = last[-1] if last else -1
    while k >= 0:
        keep[where[k][0]] = True
        k = back[k]
    return keep


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            read = [blocks(x or "") for x in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(i) for i in range(3)),
                    pa.array([m for _, _, m in read]),
                    pa.array([i if m else i + o for i, o, m in read], pa.list_(pa.string())),
                    pa.array([i + o for i, o, _ in read], pa.list_(pa.string())),
                ],
                names=["rid", "page_id", "url", "marked", "blocks", "lines"],
            )


def site_lines(own: list[int], sizes: list[int], others: list[tuple[int, list[int]]]) -> np.ndarray:
    """Which lines of a page are part of the site. ``others`` are (distance, lines), the distance negative before the page.

    What the least similar page shares is the site's in any case. On each side the nearest page counts that does not
    share more than half of what is left without it: such a page is a copy.
    """
    gone, weight = np.zeros(len(own), bool), np.array(sizes, np.int64)
    same = [(d, shared(own, lines)) for d, lines in sorted(others, key=lambda o: (abs(o[0]), o[0]))]
    if not same:
        return gone
    base = min((s for _, s in same), key=lambda s: weight[s].sum())
    if 2 * weight[base].sum() > weight.sum():
        if len(same) == 1:  # a copy, or a short article: one page does not tell
            return gone
        base = np.logical_and.reduce([s for _, s in same])
    for side in (-1, 1):
        usable = (s for d, s in same if d * side > 0 and 2 * weight[s & ~base].sum() <= weight[~base].sum())
        gone |= next(usable, gone)
    return gone


def edge_lines(own: list[int], sizes: list[int], others: list[list[int]]) -> np.ndarray:
    """Which lines of a marked article stand at the same place from its start or end in every other page that is not a copy."""
    gone, weight, met = np.zeros(len(own), bool), np.array(sizes, np.int64), []
    for lines in others:
        if 2 * weight[shared(own, lines)].sum() <= weight.sum():
            met.append(lines)
    if len(met) >= LEAST_MET:
        gone[: min(_run(own, x) for x in met)] = True
        gone[len(own) - min(_run(own[::-1], x[::-1]) for x in met) :] = True
    return gone


def _run(a: list[int], b: list[int]) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the blocks that belong to the site."""
    for batch in batches:
        out = []
        for host, key, pages in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            own = next(p for p in pages if not p["distance"])
            others = [p for p in pages if p["distance"]]
            if own["marked"]:
                n = own["inner"]
                gone = edge_lines(own["lines"][:n], own["sizes"][:n], [p["lines"][: p["inner"]] for p in others if p["inner"]])
            else:
                gone = site_lines(own["lines"], own["sizes"], [(p["distance"], p["lines"]) for p in others])
            if gone.any():
                out.append((host, key, np.flatnonzero(gone).tolist()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.list_(pa.int64())))], names=["host", "key", "gone"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    picked = pages.select(
        F.xxhash64(id_col, url_col, html_col).alias("rid"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    read = settle(
        picked.mapInArrow(_parse, "rid long, page_id long, url string, marked boolean, blocks array<string>, lines array<string>").select(
            "rid",
            "page_id",
            "url",
            "marked",
            "blocks",
            F.regexp_extract("url", _host, 1).alias("host"),
            F.regexp_extract("url", _path, 1).alias("path"),
            F.transform("lines", lambda x: F.xxhash64(x)).alias("lines"),
            F.transform("lines", F.length).alias("sizes"),
        ),
        "pages",
    )
    read = read.withColumn("inner", F.when(F.col("marked"), F.size("blocks")).otherwise(0)).withColumn("key", F.xxhash64("marked", "inner", "lines"))
    # Equal pages of a host are one, at the first of their URLs. Only hashes of lines are moved to find the neighbours.
    ordered = dense_numbers(
        read.where((F.coalesce("host", F.lit("")) != "") & (F.size("lines") > 0))
        .groupBy("host", "key")
        .agg(F.min(F.struct("path", "rid", "marked", "inner", "lines", "sizes")).alias("page"))
        .select("host", "key", "page.*"),
        ["host", "path", "rid"],
        "position",
    )
    largest = ordered.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    far = sorted(d for d in {3, *(1 << k for k in range(max(0, largest - 1).bit_length()))} if d < largest)
    steps = [0, *(side * d for d in far for side in (-1, 1))]
    # A marked page can lose its first or last line only if enough other pages begin or end with it.
    ends = ordered.where(F.col("marked") & (F.col("inner") > 0)).select(
        "host", "key", "position", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("lines")[0].alias("line")), F.struct(F.lit(1).alias("end"), F.col("lines")[F.col("inner") - 1].alias("line")))).alias("edge")
    ).select("host", "key", "position", "edge.*")
    often = settle(ends.groupBy("host", "end", "line").count().where(F.col("count") > LEAST_MET).drop("count"), "often")
    asking = ordered.where(~F.col("marked")).select("host", "key", "position").unionByName(ends.join(often, ["host", "end", "line"], "left_semi").select("host", "key", "position").distinct())
    wanted = asking.select("host", "key", "position", F.explode(F.array(*map(F.lit, steps))).alias("distance"))
    # A page meets those one to four places away and at every further power of two, up to the size of its host.
    met = wanted.select(F.col("host"), F.col("key").alias("of"), (F.col("position") + F.col("distance")).alias("position"), "distance").join(
        ordered, ["host", "position"]
    )
    around = met.groupBy("host", "of").agg(F.collect_list(F.struct("distance", "marked", "inner", "lines", "sizes")).alias("pages"))
    # Written first, so that a small table is broadcast and the texts are not moved.
    gone = settle(around.mapInArrow(_differ, "host string, key long, gone array<long>"), "gone")
    left = F.filter("blocks", lambda x, i: ~F.coalesce(F.array_contains("gone", i.cast("long")), F.lit(False)))
    return (
        read.join(gone, ["host", "key"], "left")
        .select("page_id", "url", F.array_join(left, "\n\n").alias("text"))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )

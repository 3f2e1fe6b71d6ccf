"""Main text of pages by wrappers: union-free expressions that all pages of a host match.

Every page is a stream of tags and texts. Repeats within a page become repeated groups; then the streams of a
host's pages are aligned one after another, and each mismatch is resolved: unlike texts become a text slot, parts
that only some pages have become optional, and runs of the same kind become repeated groups. Expressions are
nested lists, so streams are aligned level by level. A wrapper's slots say what each text of a page is; a slot that is the same
on all pages of its host is part of the template, inside the article too.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.page_tree import LINKS, TEXT, Block, parse
from telemetra.sources.scans import materialise

# Longest sequence of neighbours that is recognised as one repeated group.
PERIOD = 4
# Pages that a text must be the same on to count as part of the template.
TEMPLATE_PAGES = 5
# Expressions of a host are first aligned in so many parts, then the parts.
PARTS = 16
GROUP = "()"
# Distinct streams that a task remembers decisions for.
REMEMBERED = 20_000

# Elements and class words of what is not the main text.
BOILERPLATE = frozenset(
    "head title nav menu aside footer form fieldset search button select option textarea noscript template svg iframe object video audio"
    " canvas dialog".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb"
    " breadcrumbs header masthead footer sidebar aside widget notice notices alert cookie cookies consent popup modal overlay newsletter"
    " subscribe subscription signup login search form share sharing social comment comments reply replies respond disqus related"
    " recommended copyright toolbar pagination complementary contentinfo skip site-header site-footer site-nav main-nav page-header page-footer"
    " ad-banner ad-slot ad-container cookie-banner cookie-notice cookie-consent share-buttons social-links social-share comment-list comment-form"
    " related-posts related-articles newsletter-signup sidebar-left sidebar-right skip-link".split()
)
# Class words decide on an element only if it holds less of the page's text than this.
MOST = 0.5
MAIN = frozenset(("article", "main"))


def _split(key: str) -> tuple[str, list[str]]:
    name, *words = key.split(".")
    return name, words


def is_boilerplate(key: str, in_main: bool) -> bool:
    """Whether an element's name, or one of its classes as a whole, says that it isn't main text."""
    name, _ = _split(key)
    return _by_name(key, in_main) or (name not in MAIN and _by_class(key))


def _by_name(key: str, in_main: bool) -> bool:
    name, _ = _split(key)
    return name in BOILERPLATE or (name == "header" and not in_main)


def _by_class(key: str) -> bool:
    name, words = _split(key)
    return name not in ("body", "html") and any(word in BOILERPLATE_WORDS for word in words)


# An expression is [key, optional, repeated, parts]; that of a text is [# or #a, optional, repeated, lowest, highest, pages],
# where lowest and highest are hashes of its texts, alike if all are the same.


def _is_text(part: list) -> bool:
    return part[0] in (TEXT, LINKS)


def expression(block: Block) -> list:
    """The expression of one page's blocks, repeats folded."""
    if block.key in (TEXT, LINKS):
        value = xxhash.xxh3_64_intdigest(block.text.encode("utf-8", "surrogatepass")) >> 1
        return [block.key, False, False, value, value, 1]
    return [block.key, False, False, fold([expression(child) for child in block.children])]


def _same(part: list) -> str:
    """What parts must share to be aligned."""
    return part[0] if part[0] != GROUP else GROUP + " ".join(_same(inner) for inner in part[3])


def fold(parts: list[list]) -> list[list]:
    """Neighbours of the same kind, or the same sequence of kinds, become one repeated group."""
    for period in range(1, PERIOD + 1):
        folded, i = [], 0
        kinds = [_same(part) for part in parts]
        while i < len(parts):
            end = i + period
            while kinds[end : end + period] == kinds[i : i + period] and end + period <= len(parts):
                end += period
            if end > i + period and (period == 1 or len(set(kinds[i : i + period])) > 1):
                group = parts[i : i + period]
                for j in range(i + period, end, period):
                    group = [merge(a, b) for a, b in zip(group, parts[j : j + period])]
                folded.append([*group[0][:2], True, *group[0][3:]] if period == 1 else [GROUP, False, True, group])
                i = end
            else:
                folded.append(parts[i])
                i += 1
        parts = folded
    return parts


def merge(a: list, b: list) -> list:
    """The expression of all that two of one kind express."""
    flags = [a[0], a[1] or b[1], a[2] or b[2]]
    if _is_text(a):
        return [*flags, min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5]]
    return [*flags, align(a[3], b[3])]


def align(a: list[list], b: list[list]) -> list[list]:
    """Align two sequences on their longest common subsequence of kinds; what only one has becomes optional."""
    kinds_a, kinds_b = [_same(part) for part in a], [_same(part) for part in b]
    if kinds_a == kinds_b:
        return [merge(x, y) for x, y in zip(a, b)]
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if kinds_a[i] == kinds_b[j] else max(length[i + 1][j], length[i][j + 1])
    result, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and kinds_a[i] == kinds_b[j]:
            result.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and length[i + 1][j] >= length[i][j + 1]):
            result.append(_optional(a[i]))
            i += 1
        else:
            result.append(_optional(b[j]))
            j += 1
    return fold(result)


def _optional(part: list) -> list:
    return [part[0], True, *part[2:]]


def text_slots(part: list, path: tuple = ()) -> Iterator[tuple[tuple, list]]:
    """(path of kinds, text slot) of an expression, in order."""
    if _is_text(part):
        yield (*path, part[0]), part
    else:
        inside = path if part[0] == GROUP else (*path, part[0])
        for inner in part[3]:
            yield from text_slots(inner, inside)


def shape(part: list) -> list:
    """An expression without what its texts say."""
    return part[:3] if _is_text(part) else [*part[:3], [shape(inner) for inner in part[3]]]


def filled(structure: list, values: Iterator[tuple[int, int, int]]) -> list:
    """A shape with (lowest, highest, pages) of its texts, in order."""
    return [*structure, *next(values)] if _is_text(structure) else [*structure[:3], [filled(inner, values) for inner in structure[3]]]


def _single_slots(part: list, path: tuple = ()) -> Iterator[tuple[tuple, list]]:
    """(path, text slot) of those that every page has once: neither they nor what they stand in is optional or repeated."""
    if not (part[1] or part[2]):
        if _is_text(part):
            yield (*path, part[0]), part
        else:
            for inner in part[3]:
                yield from _single_slots(inner, (*path, part[0]))


def template_slots(wrapper: list) -> set[tuple]:
    """Paths whose text is the same on all pages of the host.

    Inside an article or main element every page must have it once, and another text that all have once must differ: pages that are all
    copies of one do not tell what of it is template.
    """
    found: dict[tuple, tuple[int, int, int]] = {}
    for path, slot in text_slots(wrapper):
        low, high, pages = found.get(path, (slot[3], slot[4], 0))
        found[path] = (min(low, slot[3]), max(high, slot[4]), pages + slot[5])
    same = {path for path, (low, high, pages) in found.items() if low == high and pages >= TEMPLATE_PAGES}
    main = {path for path in found if any(_split(key)[0] in MAIN for key in path)}
    single = [(path, slot) for path, slot in _single_slots(wrapper) if path in main]
    differ = any(slot[3] != slot[4] for _, slot in single)
    return same - main | (same & {path for path, _ in single} if differ else set())


def main_blocks(root: Block, template: set[tuple]) -> Iterator[str]:
    """Main text of a page: what is in an article or main element, or else in the page, but for boilerplate and the host's template.

    An article or main element without text doesn't count. A class says nothing about an element that holds an article or main
    element, or most of the page's text.
    """
    sizes: dict[int, int] = {}
    holds_main: dict[int, bool] = {}

    def measure(block: Block) -> None:
        for child in block.children:
            measure(child)
        sizes[id(block)] = len(block.text) + sum(sizes[id(child)] for child in block.children)
        own = [child for child in block.children if not _by_name(child.key, False)]
        holds_main[id(block)] = any((_split(child.key)[0] in MAIN and sizes[id(child)] > 0) or holds_main[id(child)] for child in own)

    measure(root)
    has_main, most = holds_main[id(root)], MOST * sizes[id(root)]

    def dropped(block: Block, in_main: bool) -> bool:
        if _by_name(block.key, in_main):
            return True
        return _split(block.key)[0] not in MAIN and _by_class(block.key) and not holds_main[id(block)] and sizes[id(block)] <= most

    def walk(block: Block, path: tuple, in_main: bool) -> Iterator[str]:
        for child in block.children:
            inside = (*path, child.key)
            if child.key in (TEXT, LINKS):
                if inside not in template and (in_main or not (has_main or child.key == LINKS)):
                    yield child.text
            elif not dropped(child, in_main):
                yield from walk(child, inside, in_main or _split(child.key)[0] in MAIN)

    return walk(root, (root.key,), False)



def host(url: Column) -> Column:
    """Lower-case host of a url; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def infer(pages: DataFrame) -> DataFrame:
    """A wrapper (JSON text) for each host, from all its pages: rows (host, wrapper).

    Pages are reduced to their shapes first, and what is known of each text slot to the lowest and highest hash, so that a
    host's pages count by the shapes they have; these are aligned in parts and then over all parts.
    """

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str], list] = {}
            for name, page in zip(batch["host"], batch["html"]):
                whole = expression(parse(page))
                key = (name, json.dumps(shape(whole), separators=(",", ":")))
                values = [slot[3:] for _, slot in text_slots(whole)]
                if key in seen:
                    values = [[min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]] for a, b in zip(seen[key], values)]
                seen[key] = values
            rows = [(*key, i, *value) for key, values in seen.items() for i, value in enumerate(values or [[0, 0, 0]])]
            yield pd.DataFrame(rows, columns=["host", "shape", "slot", "low", "high", "pages"])

    found = pages.mapInPandas(shapes, "host string, shape string, slot int, low long, high long, pages long")
    slots = found.groupBy("host", "shape", "slot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pages").alias("pages"))

    def align_shapes(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for structure, part in rows.sort_values(["shape", "slot"]).groupby("shape", sort=True):
            values = iter(zip(part["low"].tolist(), part["high"].tolist(), part["pages"].tolist()))
            one = filled(json.loads(structure), values)
            whole = one if whole is None else merge(whole, one)
        return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(whole, separators=(",", ":"))]})

    def align_wrappers(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [json.loads(wrapper) for wrapper in sorted(rows["wrapper"])]
        whole = parts[0]
        for part in parts[1:]:
            whole = merge(whole, part)
        return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(whole, separators=(",", ":"))]})

    part = F.pmod(F.xxhash64("shape"), F.lit(PARTS)).alias("part")
    in_parts = slots.groupBy("host", part).applyInPandas(align_shapes, "host string, wrapper string")
    return in_parts.groupBy("host").applyInPandas(align_wrappers, "host string, wrapper string")


def extract(pages: DataFrame, url_column: str = "url", html_column: str = "html", to: str = "main_text") -> DataFrame:
    """Add the main text of every page: blocks in page order, joined by line feeds; empty for null or empty pages.

    Character references are decoded, white space within a block becomes one space. Pages without a host
    share a wrapper. No row is lost or repeated, and every other column stays as it is.
    """
    named = pages.select(host(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    wrappers = materialise(infer(named), "wrappers").until_exit().select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))

    @F.pandas_udf("string")
    def main_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        templates: dict[str | None, set[tuple]] = {None: set()}
        for documents, found in batches:
            texts = []
            for page, wrapper in zip(documents, found):
                if wrapper not in templates:
                    if len(templates) > REMEMBERED:
                        templates = {None: set()}
                    templates[wrapper] = template_slots(json.loads(wrapper))
                texts.append("\n".join(main_blocks(parse(page), templates[wrapper])))
            yield pd.Series(texts, dtype=object)

    joined = pages.join(wrappers, host(F.col(url_column)) == F.col("_host"), "left")
    return joined.withColumn(to, main_text(F.col(html_column), F.col("_wrapper"))).drop("_host", "_wrapper")

"""Main text of web pages by wrappers: union-free expressions inferred from pages of one host.

A page's tokens form a tree of labelled elements and text slots. The wrapper of a host aligns its
pages' trees one after the other: at each level the sequences of children are aligned, runs of equal
labels become repeated groups, children that only some pages have become optional groups, and texts
become slots whose sizes add up and whose texts are compared: a slot with one text on several pages
is template, others are content. The wrapper then names the elements that hold the article and those
inside that don't belong to it, and every page of the host gives the text of its slots there.

Merging wrappers is associative, so each task merges the pages it reads and a host's partial
wrappers, a few small trees however many pages it has, meet in one group.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Generator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens

# Fixed values of HTML: elements by how they nest and what they hold.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
#: Elements that an element of the same group ends, within the nearest of the parents.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that never hold an article's text.
ASIDE = frozenset(
    "nav footer aside button select menu svg canvas object audio video head".split()
) | RAW
#: Elements that seldom hold an article, but may hold a whole page. The wrapper decides.
SELDOM = frozenset("form dialog".split())
#: Words in classes, ids and roles that often mark what surrounds an article. The wrapper decides.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination popup promo promos "
    "promotion recommended related replies respond responses search share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget".split())
#: Whole classes and ids of reader comments, which may well be longer than what they are about.
COMMENTS = frozenset(
    "comment comments comment-list comment-section commentlist comments-area comments-list "
    "comments-section disqus_thread replies responses".split())

#: Ends labels of elements with such a word, so that they are aligned among themselves.
MARKED, COMMENTED = ".!", ".!c.!"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Element:
    """An element of a page: label, whether it lies outside articles, children and texts in order."""

    __slots__ = ("name", "label", "aside", "children")

    def __init__(self, name: str, label: str, aside: bool):
        self.name, self.label, self.aside, self.children = name, label, aside, []


def _element(name: str, attributes: str) -> Element:
    label, aside = name, name in ASIDE
    if attributes and "=" in attributes or "hidden" in attributes:
        found = {
            k.lower(): (v[1:-1] if v[:1] in "\"'" and v else v)
            for k, v in _ATTRIBUTE.findall(attributes)}
        first = found.get("class", "").split()
        if first:
            label += "." + re.sub(r"[\d/]+", "", first[0])  # "/" parts labels in paths
        words = re.split(r"[\s_-]+", " ".join(
            found.get(k, "") for k in ("class", "id", "role")).lower())
        aside = aside or "hidden" in found
        if "main" == found.get("role"):
            label = "main"
        if name not in ("html", "body", "article", "main") and not COMMENTS.isdisjoint(
                " ".join(found.get(k, "") for k in ("class", "id")).lower().split()):
            label += COMMENTED
        elif name not in ("html", "body") and not MARKS.isdisjoint(words):
            label += MARKED
    if name in SELDOM and not label.endswith(MARKED):
        label += MARKED
    return Element(name, label, aside)


def parse(page: str) -> Element:
    """The tree of a page. Missing end tags are implied; end tags without a start are ignored."""
    root = Element("#root", "#root", False)
    stack, at = [root], 0
    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text.strip():
            stack[-1].children.append(text)
        elif text and stack[-1].children:
            stack[-1].children.append(" ")
        if not found:
            return root
        at = found.end()
        end, name, attributes = found.group(1), found.group(2), found.group(3)
        if name is None:
            end, name, attributes = found.group(4), found.group(5), found.group(6)
        if name is None:
            continue
        name = name.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if name in BLOCKS:
            _close(stack, {"p"}, BLOCKS - {"p"})
        if name in SIBLINGS:
            _close(stack, *SIBLINGS[name])
        element = _element(name, attributes)
        stack[-1].children.append(element)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif name not in VOID and not attributes.endswith("/"):
            stack.append(element)


def _close(stack: list[Element], names: set[str], limits) -> None:
    """End the innermost open element of ``names`` unless one of ``limits`` lies between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name in names:
            del stack[i:]
            return
        if stack[i].name in limits:
            return


# --- wrappers -------------------------------------------------------------------------------------
# Pages may nest as deep as they are long, so what walks trees is written as generators that yield
# the calls they wait for; ``_run`` keeps those on a list.


def _run(call: Generator):
    """The result of ``call`` and of all calls it yields."""
    stack, value = [call], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


class Group:
    """A part of a wrapper: one element of the expression with its flags and its own expression."""

    __slots__ = (
        "label", "aside", "optional", "repeated", "chars", "linked", "pages", "text", "parts")

    def __init__(self, label: str, aside: bool):
        self.label, self.aside = label, aside
        self.pages, self.text = 1, ""  # pages at least; hash of the slots, None if texts differ
        self.optional = self.repeated = False
        self.chars = self.linked = 0  # of text slots directly inside, and of those in links
        self.parts: list[Group] = []

    def as_list(self) -> list:
        """Rows (depth, label, flags and sizes) from the outside in, in order."""
        out, stack = [], [(0, self)]
        while stack:
            depth, g = stack.pop()
            out.append([depth, g.label, g.aside, g.optional, g.repeated, g.chars, g.linked,
                        g.pages, g.text])
            stack.extend((depth + 1, p) for p in reversed(g.parts))
        return out

    @staticmethod
    def from_list(data: list) -> Group:
        line: list[Group] = []
        for depth, label, aside, *rest in data:
            group = Group(label, aside)
            (group.optional, group.repeated, group.chars, group.linked, group.pages,
             group.text) = rest
            del line[depth:]
            if line:
                line[-1].parts.append(group)
            line.append(group)
        return line[0]


def wrapper_of(element: Element) -> Group:
    """The expression of one page's element: runs of children with one label are folded."""
    return _run(_wrapper_of(element, False))


def _wrapper_of(element: Element, link: bool):
    out = Group(element.label, element.aside)
    link = link or element.name == "a"
    slots = [c.strip() for c in element.children if isinstance(c, str) and c.strip()]
    if slots:
        out.text = hashlib.md5("\0".join(slots).encode("utf-8", "replace")).hexdigest()
    for child in element.children:
        if isinstance(child, str):
            n = len(child.strip())
            out.chars += n
            out.linked += n if link else 0
            continue
        part = yield _wrapper_of(child, link)
        if out.parts and out.parts[-1].label == part.label:
            out.parts[-1] = yield _merge(out.parts[-1], part, True)
            out.parts[-1].repeated = True
        else:
            out.parts.append(part)
    yield _fold(out)
    return out


def _fold(group: Group):
    """Fold runs of several labels that follow one another again: a b a b becomes (a b)+."""
    for size in range(2, 5):
        at = 0
        while at + 2 * size <= len(group.parts):
            one, two = group.parts[at : at + size], group.parts[at + size : at + 2 * size]
            if [p.label for p in one] == [p.label for p in two]:
                for i in range(size):
                    one[i] = yield _merge(one[i], two[i], True)
                    one[i].repeated = True
                group.parts[at : at + 2 * size] = one
            else:
                at += 1


def merge(a: Group, b: Group) -> Group:
    """The expression of both: common parts in order, the rest optional."""
    return _run(_merge(a, b, False))


def _merge(a: Group, b: Group, same_pages: bool):
    out = Group(a.label, a.aside and b.aside)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.chars, out.linked = a.chars + b.chars, a.linked + b.linked
    out.pages = max(a.pages, b.pages) if same_pages else a.pages + b.pages
    out.text = a.text if a.text == b.text else None
    left, right = [p.label for p in a.parts], [p.label for p in b.parts]
    if left == right:
        for x, y in zip(a.parts, b.parts, strict=True):
            out.parts.append((yield _merge(x, y, same_pages)))
        return out
    # Longest common subsequence of labels, from the ends.
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = (
                best[i + 1][j + 1] + 1 if left[i] == right[j]
                else max(best[i + 1][j], best[i][j + 1]))
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i] == right[j]:
            part, i, j = (yield _merge(a.parts[i], b.parts[j], same_pages)), i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            part, i = a.parts[i], i + 1
            part.optional = True
        else:
            part, j = b.parts[j], j + 1
            part.optional = True
        if out.parts and out.parts[-1].label == part.label:  # optional runs meet: a? a+ is a+
            part = yield _merge(out.parts[-1], part, True)
            part.repeated = True
            out.parts[-1] = part
        else:
            out.parts.append(part)
    return out


def _kind(group: Group) -> str:
    return group.label.split(".")[0]


def _marked(group: Group) -> bool:
    return group.label.endswith(MARKED)


def _inside(group: Group, enter) -> list[Group]:
    """``group`` and the groups below it in order, not below those that ``enter`` refuses."""
    out, stack = [], [group]
    while stack:
        g = stack.pop()
        out.append(g)
        if g is group or enter(g):
            stack.extend(reversed(g.parts))
    return out


def _weights(wrapper: Group):
    """(own, full): functions from a group to its content, in characters outside of links.

    Content is text that differs between pages. Where that says nothing, on a single page or if most
    text outside of marked elements is the same on all of them, all text counts.
    """
    whole = _inside(wrapper, lambda g: not g.aside)
    free = _inside(wrapper, lambda g: not (g.aside or _marked(g)))
    template = sum(_constant(g) * (g.chars - g.linked) for g in free if not (g.aside or _marked(g)))
    content = sum(not _constant(g) and g.chars - g.linked for g in whole if not g.aside)
    compare = content > template

    def own(g: Group) -> int:
        return 0 if compare and _constant(g) else g.chars - g.linked

    sums: dict[int, int] = {}
    for g in reversed(whole):  # parts come before what they are part of
        sums[id(g)] = 0 if g.aside else own(g) + sum(sums[id(p)] for p in g.parts)
    return compare, own, lambda g: sums.get(id(g), 0)


def _constant(group: Group) -> bool:
    """Whether several pages have the same text, or none, in the group's own slots."""
    return group.pages > 1 and group.text is not None


def _surrounding(wrapper: Group, own, full) -> set[int]:
    """Ids of the marked groups that hold less content than all that isn't marked beside them.

    They are compared within articles, or else within main elements, if these hold half of what
    isn't marked, or else in the whole wrapper; outside of the former all marked groups go. Reader
    comments go whatever their length, unless there is nothing beside them.
    """
    def free(g: Group) -> bool:
        return not (g.aside or _marked(g))

    reached = _inside(wrapper, free)
    gone = {id(g) for g in reached if _marked(g)}
    scopes = [wrapper]
    for kind in ("article", "main"):
        found = [g for g in reached if free(g) and _kind(g) == kind and full(g)]
        if found and 2 * sum(map(full, found)) >= sum(own(g) for g in reached if free(g)):
            scopes = found
            break
    while scopes:
        scope = scopes.pop()
        reached = _inside(scope, free)
        beside = sum(own(g) for g in reached if g is scope or free(g))
        for g in reached[1:]:
            if _marked(g):
                gone.add(id(g))
                least = 0 if g.label.endswith(COMMENTED) else full(g) - 1
                if not g.aside and full(g) and beside <= least:
                    gone.discard(id(g))
                    scopes.append(g)
    return gone


def _template(article: Group, gone: set[int]) -> set[int]:
    """Ids of blocks in the article with the same text on several pages, before or after all that
    differs, if most of the article differs.

    What stands between texts that differ belongs to the article, however many pages share it:
    headings of a recipe's parts, a byline, a quotation. Only a box of its own there, a division
    or section that says the same on several pages, is taken for a notice.
    """
    inside = _inside(article, lambda g: not (g.aside or id(g) in gone))
    same: dict[int, bool] = {}
    chars: dict[int, int] = {}
    for g in reversed(inside):
        if g.aside or id(g) in gone:
            same[id(g)], chars[id(g)] = True, 0
        else:
            same[id(g)] = _constant(g) and all(same[id(p)] for p in g.parts)
            chars[id(g)] = g.chars + sum(chars[id(p)] for p in g.parts)
    varying = [
        i for i, g in enumerate(inside)
        if g.chars and not (g.aside or id(g) in gone) and not _constant(g)]
    if not varying:
        return set()
    blocks = [
        g for i, g in enumerate(inside) if i and _kind(g) in BLOCKS and same[id(g)]
        and chars[id(g)] and (_kind(g) in _BOXES or not varying[0] < i < varying[-1])]
    below = {id(p) for g in blocks for p in _inside(g, lambda p: True)[1:]}
    dropped = sum(chars[id(g)] for g in blocks if id(g) not in below)
    return {id(g) for g in blocks} if 2 * dropped < chars[id(article)] else set()


def article_paths(wrapper: Group) -> tuple[list[str], list[str]]:
    """Paths of labels to the elements that hold the article, and to those in it that don't.

    The former are the outermost article elements, or else main ones, if they hold no less content
    than any other element has in its own blocks, outside of links. Otherwise they are that element
    and those beside it that hold a fifth as much. The latter are marked elements without the main
    content, and blocks of template text at the edges.
    """
    compare, content, full = _weights(wrapper)
    gone = _surrounding(wrapper, content, full)
    found: dict[str, set[int]] = {"article": set(), "main": set()}
    # Paths are numbers, and written out at the end: a deep one is as long as all above it together.
    numbers: dict[tuple[int, str], int] = {}
    steps: list[tuple[int, str]] = []
    mass: dict[int, float] = {}
    totals: dict[int, int] = {}
    places: dict[int, list[Group]] = {}

    def number(parent: int, label: str) -> int:
        if (parent, label) not in numbers:
            numbers[parent, label] = len(steps)
            steps.append((parent, label))
        return numbers[parent, label]

    def written(path: int) -> str:
        labels = []
        while path >= 0:
            path, label = steps[path]
            labels.append(label)
        return "/".join(reversed(labels))

    def walk(group: Group, path: int, inside: str):
        """Characters of text in the group, outside of links and of what surrounds articles."""
        if group.aside or id(group) in gone:
            return 0
        here = _kind(group) if _kind(group) in found else ""
        own = content(group)
        places.setdefault(path, []).append(group)
        below = []
        for p in group.parts:
            below.append((p, (yield walk(p, number(path, p.label), inside or here))))
        total = own + sum(n for _, n in below)
        totals[path] = totals.get(path, 0) + total
        if here and total and here not in inside:
            found[here].add(path)
        # Text directly inside or in blocks right below counts for the container.
        mass[path] = own + sum(n for p, n in below if _kind(p) not in _CONTAINERS)
        return total

    _run(walk(wrapper, number(-1, wrapper.label), ""))
    most = max(mass.values(), default=0)
    # As many labels as fit are written out only for paths of equal content.
    best = {p for p, n in mass.items() if n == most} if most else set()
    if len(best) > 1:
        best = {max(best, key=lambda p: (-len(written(p)), written(p)))}
    for p in list(best):
        parent = steps[p][0]
        best |= {q for q, n in mass.items() if parent >= 0 and steps[q][0] == parent
                 and 5 * n >= most and steps[q][1].split(".")[0] in _CONTAINERS}
    chosen = best
    for kind in ("main", "article"):
        if found[kind] and sum(totals[p] for p in found[kind]) >= most:
            chosen = found[kind]
    drop, keep = set(), set()
    for path in chosen:
        for group in places[path]:
            out = gone | _template(group, gone) if compare else gone
            stack = [(group, path)]
            while stack:
                g, at = stack.pop()
                if id(g) in out:
                    drop.add(at)
                elif not g.aside:
                    keep.add(at)
                    stack.extend((p, number(at, p.label)) for p in g.parts)
    # A path that names several groups is dropped if all of them are.
    return sorted(map(written, chosen)), sorted(map(written, drop - keep))


_BOXES = frozenset("div section center fieldset header".split())
_CONTAINERS = frozenset("html body div section main article table tbody tr td ul ol dl".split())


def main_text(root: Element, paths: list[str], dropped: list[str]) -> str:
    """The text of a page's elements at ``paths`` without those at ``dropped``: blocks in page order,
    one line each."""
    blocks, line = [], []
    wanted: dict = {}  # by label, the paths below it; True ends one of paths, False a dropped one
    for end, ends in ((True, paths), (False, dropped)):
        for path in ends:
            at = wanted
            for label in path.split("/"):
                at = at.setdefault(label, {})
            at[end] = {}

    def flush() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    def walk(element: Element, at: dict, inside: bool):
        entered = not inside and True in at
        # A heading group of the article is its own, any other header surrounds it.
        if element.aside or False in at or (element.name == "header" and not inside):
            return
        inside = inside or entered
        block = element.name in BLOCKS
        if inside and block:
            flush()
        for child in element.children:
            if isinstance(child, str):
                if inside:
                    line.append(child)
            elif child.name == "br":
                line.append(" ")
            elif inside or child.label in at:
                yield walk(child, at.get(child.label, {}), inside)
        if inside and block or entered:
            flush()

    _run(walk(root, wanted.get(root.label, {}), False))
    flush()
    return "\n".join(blocks)


# --- on Spark -------------------------------------------------------------------------------------


def infer(pages: DataFrame) -> DataFrame:
    """(host, paths, dropped): where each host's pages hold their article, from all its pages."""

    def partial(batches):
        for batch in tokens.pieces(batches):
            wrappers: dict[str, Group] = {}
            for host, page in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                one = wrapper_of(parse(page))
                wrappers[host] = merge(wrappers[host], one) if host in wrappers else one
            yield pa.RecordBatch.from_arrays([
                pa.array(list(wrappers), pa.string()),
                pa.array([json.dumps(w.as_list()) for w in wrappers.values()], pa.string()),
            ], ["host", "wrapper"])

    def whole(key, table):
        wrapper = None
        for data in sorted(table.column("wrapper").to_pylist()):
            part = Group.from_list(json.loads(data))
            wrapper = part if wrapper is None else merge(wrapper, part)
        paths, dropped = article_paths(wrapper)
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()),
                         "paths": pa.array([paths], pa.list_(pa.string())),
                         "dropped": pa.array([dropped], pa.list_(pa.string()))})

    return (
        pages.where("html is not null").select("host", "html")
        .mapInArrow(partial, "host string, wrapper string")
        .groupBy("host").applyInArrow(whole, "host string, paths array<string>, dropped array<string>")
    )


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``pages`` with ``__text``: the article of each page, blocks in page order joined by newlines.

    Hosts come from ``url``; pages without one share a wrapper. White space within a block becomes
    one space, character references are decoded, empty blocks vanish. A page that has none of its
    host's article elements is read by a wrapper of its own. NULL and empty pages, and pages without
    any article text, give an empty text. Rows, repeated or not, and other columns stay as they are.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z]+://([^/?#]*)", 1)), F.lit(""))
    hosted = pages.withColumn("__host", host)
    wrappers = infer(hosted.select(F.col("__host").alias("host"), F.col(page).alias("html"))).select(
        F.col("host").alias("__host"), F.col("paths").alias("__paths"),
        F.col("dropped").alias("__dropped"))

    names = pages.columns

    def texts(batches):
        for batch in tokens.pieces(batches):
            out = []
            column = batch.column(batch.schema.get_field_index(page)).to_pylist()
            for source, paths, dropped in zip(
                column, batch.column(batch.num_columns - 2).to_pylist(),
                batch.column(batch.num_columns - 1).to_pylist(), strict=True
            ):
                root = parse(source or "")
                text = main_text(root, paths or [], dropped or [])
                if not text and source:
                    text = main_text(root, *article_paths(wrapper_of(root)))
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(out, pa.string())], [*names, "__text"])

    joined = hosted.join(wrappers, "__host", "left").select(*names, "__paths", "__dropped")
    schema = ", ".join(f"`{n}` {t}" for n, t in pages.dtypes)
    return joined.mapInArrow(texts, f"{schema}, __text string")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``extract``."""
    return found.select(
        "page_id", "url", F.col("__text").alias("text"),
        F.length("__text").cast("long").alias("n_chars"))

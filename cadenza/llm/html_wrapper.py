"""Main text of web pages by wrappers inferred per host (operator 8).

A page is a stream of block tags and texts. For every host a union-free
regular expression, its wrapper, is inferred from the streams of all of its
pages: a stretch that repeats side by side becomes a repeated group, and
streams are aligned with each other, so that what only some have becomes
optional. Every page is matched against its host's wrapper. A place of texts
in the wrapper where all pages that have it say the same is template, any
other one a slot. The innermost container of the wrapper that holds half of
the text in slots, an article or main if there is one, holds the host's main
text; what a page has in it, without menus, adverts and the like, is the
page's main text (texts of the template too, as a heading may be one).

Every row of a host counts. A null html is empty. Pages with a null or
malformed url share one host. Repeated rows get the same answer each. Pages
that do not match the host's container use a container of its label, else
their own article, main or body. Extra columns are ignored.
"""

from __future__ import annotations

import difflib
import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, slices, stored, table

SHARE = 0.5  # of a host's text in slots that its content container must hold
FAN = 32  # streams that one task aligns into one; a host with more takes several turns

# Fixed lists of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = set("nav header footer aside form script style noscript iframe svg canvas object button select option textarea template dialog head title math audio video menu".split())
DROPPED_NAMES = set(("ad ads advert adverts advertisement advertising sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                     "header footer cookie cookies consent notice notices banner popup modal newsletter subscribe comment comments disqus "
                     "share sharing social related recommended widget").split())
FRAME = set("html body main article".split())
CONTAINERS = set("body main article section div td".split())
CLOSED_BY = {"p": CONTAINERS | set("p ul ol table h1 h2 h3 h4 h5 h6 blockquote pre form nav header footer aside hr dl".split()), "li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*+>|</?[a-z][^>]*>|<[!?][^>]*>|[^<]+|<""", re.I | re.S)
_TAG = re.compile(r"<(/?)([a-z][a-z0-9:-]*)(.*)>\Z", re.I | re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is open, close or text; raw elements and comments are left out."""
    for m in _TOKEN.finditer(page):
        s = m[0]
        tag = _TAG.match(s) if s[0] == "<" and not m[1] else None
        if tag:
            yield ("close" if tag[1] else "open"), tag[2].lower(), tag[3]
        elif not m[1] and not s.startswith(("<!", "<?")):
            yield "text", "", s


def _names(rest: str) -> tuple[str, ...]:
    found = " ".join(x or y or z for x, y, z in _NAMES.findall(rest)) if "=" in rest else ""
    return tuple(sorted(set(re.findall(r"[a-z]+", found.lower()))))


def _drops(name: str, rest: str) -> bool:
    """Whether a whole word of the class, id or role says that an element is no main text. Inline tags and the page's own frame are kept."""
    if name in INLINE or name in FRAME or "=" not in rest:
        return False
    return any(w in DROPPED_NAMES for x in _NAMES.findall(rest) for w in "".join(x).lower().split())


def texts(page: str) -> tuple[list[tuple[str, str, tuple[tuple[str, int], ...], bool, int]], list[str]]:
    """Every text and block edge of a page in order, and the page's stream.

    A part is (kind, text, open containers as label and place in the stream,
    dropped, place of the text in the stream). The stream has the labels of
    block tags, each closed as HTML implies, and one '#' for the texts
    between two of them; inline tags are part of the text.

    An element dropped by its name keeps its text if it holds more than half
    of the page's (what lies in tags that are dropped anyway not counted).
    """
    stack: list[tuple[str, tuple[tuple[str, int], ...], bool, tuple[int, ...]]] = []  # tag, containers down to it, in a dropped tag, elements around it that their names drop
    found: list[tuple[str, str, tuple[tuple[str, int], ...], bool, tuple[int, ...], int]] = []
    stream: list[str] = []
    blocks: list[str] = []  # block tags open in the stream
    mass: list[int] = []
    total = 0
    for kind, name, rest in tokens(page):
        out, named = (stack[-1][2], stack[-1][3]) if stack else (False, ())
        if kind == "text":
            size = len(rest.strip())
            if size and (not stream or stream[-1] != "#"):
                stream.append("#")
            found.append(("text", rest, stack[-1][1] if stack else (), out, named, len(stream) - 1))
            if not out:
                total += size
                for i in named:
                    mass[i] += size
            continue
        if name not in INLINE:
            found.append(("edge", "", (), out, named, -1))
        if kind == "open":
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            if name in VOID or rest.endswith("/"):
                continue
            if name not in INLINE:
                while blocks and name in CLOSED_BY.get(blocks[-1], ()):
                    stream.append("/" + blocks.pop())
                blocks.append(name)
                stream.append(".".join((name, *_names(rest))))
            out, named = (stack[-1][2], stack[-1][3]) if stack else (False, ())
            if _drops(name, rest):
                named = (*named, len(mass))
                mass.append(0)
            labels = stack[-1][1] if stack else ()
            if name in CONTAINERS:
                labels = (*labels, (stream[-1], len(stream) - 1))
            stack.append((name, labels, out or name in DROPPED, named))
        else:
            if name in blocks:
                while blocks[-1] != name:
                    stream.append("/" + blocks.pop())
                stream.append("/" + blocks.pop())
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                del stack[at:]
    stream += ["/" + x for x in reversed(blocks)]
    return [(kind, text, labels, out or any(2 * mass[i] <= total for i in named), at) for kind, text, labels, out, named, at in found], stream


# ---- wrapper expressions ----------------------------------------------------
# An item is a label or a repeated group ("+", items). A wrapper is a list of
# (item, optional). Beside the items of a page go the places of their labels in
# its stream: a list of places for a label, a tuple of such for a group.

def _balanced(items: list) -> bool:
    depth = 0
    for x in items:
        if isinstance(x, str) and x != "#":
            depth += -1 if x[0] == "/" else 1
            if depth < 0:
                return False
    return depth == 0


def _joined(a, b):
    return a + b if isinstance(a, list) else tuple(_joined(x, y) for x, y in zip(a, b, strict=True))


def folded(items: list, places: list, longest: int = 10) -> tuple[list, list]:
    """Replace whole elements that repeat side by side by one repeated group."""
    for size in range(1, longest + 1):
        out, at, i = [], [], 0
        while i < len(items):
            j = i + size
            if j < len(items) and items[i] == items[j]:
                block = items[i:j]
                while len(block) == size and items[j:j + size] == block:
                    j += size
                if j > i + size and _balanced(block):
                    group = tuple(places[i:i + size])
                    for k in range(i + size, j, size):
                        group = _joined(group, tuple(places[k:k + size]))
                    out.append(("+", tuple(block)))
                    at.append(group)
                    i = j
                    continue
            out.append(items[i])
            at.append(places[i])
            i += 1
        items, places = out, at
    return items, places


def fold(items: list) -> list:
    return folded(items, [[i] for i in range(len(items))])[0]


def _as_groups(items: list, beside: list, groups: set, group_of) -> tuple[list, list]:
    """Single occurrences of a stretch that is a repeated group elsewhere become that group."""
    for group in sorted(groups, key=lambda g: (-len(g[1]), repr(g))):
        body, out, at, i = list(group[1]), [], [], 0
        while i < len(items):
            if items[i] == body[0] and items[i:i + len(body)] == body:
                at.append(group_of(beside[i:i + len(body)]))
                out.append(group)
                i += len(body)
            else:
                out.append(items[i])
                at.append(beside[i])
                i += 1
        items, beside = out, at
    return items, beside


def _groups(items: list) -> set:
    return {x for x in items if isinstance(x, tuple)}


def _steps(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """Alignment of two streams, longest equal stretches first."""
    return difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()


def align(wrapper: list, other: list) -> list:
    """The union-free expression that matches what either of two wrappers matches."""
    sides = [[x for x, _ in w] for w in (wrapper, other)]
    groups = _groups(sides[0] + sides[1])
    (a, loose_a), (b, loose_b) = (_as_groups(x, [o for _, o in w], groups, any) for x, w in zip(sides, (wrapper, other), strict=True))
    out: list = []
    for op, i, j, k, m in _steps(a, b):
        if op == "equal":
            out += [(a[x], loose_a[x] or loose_b[y]) for x, y in zip(range(i, j), range(k, m), strict=True)]
            continue
        for x in (*a[i:j], *b[k:m]):
            # Two groups side by side are one.
            if not (isinstance(x, tuple) and out and out[-1][0] == x):
                out.append((x, True))
    return out


def wrapper_of(items: list) -> list:
    return [(x, False) for x in items]


def _leaves(items: list, places: list, ids: list[str | None]) -> Iterator[tuple[str, list[int], str | None]]:
    """Label, places and id of every label of ``items`` in order; in a group, ids go on with the place in it."""
    for x, p, i in zip(items, places, ids, strict=True):
        if isinstance(x, str):
            yield x, p, i
        else:
            yield from _leaves(x[1], p, [i and f"{i}.{k}" for k in range(len(p))])


def match(wrapper: list, items: list, places: list) -> dict[int, str]:
    """For every place of a page's stream that matches the wrapper, the id of its label there."""
    own = [x for x, _ in wrapper]
    items, places = _as_groups(items, places, _groups(own) | _groups(items), tuple)
    ids: list[str | None] = [None] * len(items)
    for op, i, j, k, _ in _steps(own, items):
        if op == "equal":
            ids[k:k + j - i] = map(str, range(i, j))
    return {at: i for _, p, i in _leaves(items, places, ids) if i is not None for at in p}


def render(items) -> str:
    """Items as text: (..)+ repeated, # a place of texts."""
    return " ".join(x if isinstance(x, str) else f"({render(x[1])})+" for x in items)


def _read(x):
    return x if isinstance(x, str) else ("+", tuple(map(_read, x[1])))


def loads(wrapper: str) -> list:
    return [(_read(x), bool(optional)) for x, optional in json.loads(wrapper)]


def extract(page: str | None, container: str | None, node: str | None = None, wrapper: list | None = None) -> str:
    """Main text of a page: the blocks in what matches ``node`` of the wrapper, one line each.

    Without a match, those in containers labelled ``container``, else in the page's article, main or body.
    """
    parts, stream = texts(page or "")
    open_ = {x for p in parts if p[0] == "text" for x in p[2]}
    inside: set = set()
    if wrapper is not None and node is not None:
        ids = match(wrapper, *folded(stream, [[i] for i in range(len(stream))]))
        inside = {x for x in open_ if ids.get(x[1]) == node}
    if not inside:
        inside = {x for x in open_ if x[0] == container}
    if not inside:
        tag = next((t for t in ("article", "main", "body") if any(x[0].split(".")[0] == t for x in open_)), None)
        inside = {x for x in open_ if x[0].split(".")[0] == tag} if tag else {None}
    lines, block = [], []
    for kind, text, labels, dropped, _ in [*parts, ("edge", "", (), False, -1)]:
        if kind == "text":
            if not dropped and (None in inside or not inside.isdisjoint(labels)):
                block.append(text)
        elif block:
            line = " ".join(entities.unescape("".join(block)).split())
            block = []
            if line:
                lines.append(line)
    return "\n".join(lines)


# ---- the operator -----------------------------------------------------------

def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def streams(pages: DataFrame) -> DataFrame:
    """host, print, leaf, stream, n, mass, low, high over all pages.

    One row for each host and folded stream (``print`` its hash, leaf -1) with
    the stream as a wrapper and its pages, and one for each label of it that
    stands for kept texts: its pages, their characters and the smallest and
    largest hash of what a page has there.
    """
    def run(batches):
        for b in slices(batches, "html"):
            out: dict[tuple, list] = {}
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                parts, stream = texts(page)
                items, places = folded(stream, [[i] for i in range(len(stream))])
                text = json.dumps(wrapper_of(items), ensure_ascii=False, separators=(",", ":"))
                found = _key(text)
                leaf = {at: i for i, (_, p, _) in enumerate(_leaves(items, places, [None] * len(items))) for at in p}
                kept: dict[int, list[str]] = {}
                for kind, t, _, dropped, at in parts:
                    if kind == "text" and not dropped and (t := t.strip()):
                        kept.setdefault(leaf[at], []).append(t)
                out.setdefault((host, found, -1), [text, 0, 0, None, None])[1] += 1
                for i, there in kept.items():
                    k = _key("\n".join(there))
                    x = out.setdefault((host, found, i), [None, 0, 0, k, k])
                    x[1:] = x[1] + 1, x[2] + sum(map(len, there)), min(x[3], k), max(x[4], k)
            columns = [pa.array([x[j] for x in out], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int32()))]
            columns += [pa.array([x[j] for x in out.values()], pa.int64() if j else pa.string()) for j in range(5)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "print", "leaf", "stream", "n", "mass", "low", "high"])
    rows = pages.transform(in_batches, run, "host string, print long, leaf int, stream string, n long, mass long, low long, high long")
    return rows.groupBy("host", "print", "leaf").agg(F.max("stream").alias("stream"), F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.min("low").alias("low"), F.max("high").alias("high"))


def wrappers(found: DataFrame) -> DataFrame:
    """host, wrapper: the alignment of all ``streams`` of each host, some ``FAN`` of them a task and turn."""
    def run(batches):
        for b in batches:
            out = []
            for some in b.column("some").to_pylist():
                first, *more = map(loads, sorted(some, key=lambda x: (len(x), x)))
                for x in more:
                    first = align(first, x)
                out.append(json.dumps(first, ensure_ascii=False, separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.string())], ["host", "wrapper"])

    rows = found.where("leaf = -1").select("host", F.col("stream").alias("wrapper"))
    while True:
        size = stored(rows.groupBy("host").agg(F.count("*").alias("size")), "wrapper-sizes")
        if size.where("size > 1").isEmpty():
            return rows
        dealt = rows.join(size, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("size") / FAN)))
        rows = stored(dealt.groupBy("host", "part").agg(F.collect_list("wrapper").alias("some")).transform(in_batches, run, "host string, wrapper string"), "wrappers")


def _matched(found: DataFrame, wrapped: DataFrame) -> DataFrame:
    """host, print, leaf, slot (its id in the wrapper), nodes (containers of the wrapper around it: id, label, depth) of each place of texts."""
    def run(batches):
        for b in batches:
            own: dict[str, list] = {}
            out: list[tuple] = []
            for host, mark, stream, wrapper in zip(*(b.column(c).to_pylist() for c in ("host", "print", "stream", "wrapper")), strict=True):
                if host not in own:
                    own[host] = loads(wrapper)
                items = [x for x, _ in loads(stream)]
                labels = [x for x, _, _ in _leaves(items, *_counted(items))]
                ids = match(own[host], items, _counted(items)[0])
                around: list[dict | None] = []
                for i, label in enumerate(labels):
                    if label == "#":
                        nodes = [x for x in around if x]
                        out.append((host, mark, i, ids.get(i) or f"{mark} {i}", [{**x, "depth": d} for d, x in enumerate(nodes)]))
                    elif label[0] == "/":
                        around.pop()
                    else:
                        around.append({"node": ids[i], "label": label} if i in ids and label.split(".")[0] in CONTAINERS else None)
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.struct([("node", pa.string()), ("label", pa.string()), ("depth", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate(kinds)], ["host", "print", "leaf", "slot", "nodes"])
    rows = found.where("leaf = -1").join(wrapped, "host").select("host", "print", "stream", "wrapper")
    return rows.transform(in_batches, run, "host string, print long, leaf int, slot string, nodes array<struct<node: string, label: string, depth: int>>")


def _counted(items) -> tuple[list, list]:
    """Places that number the labels of ``items`` in order, and as many empty ids."""
    at = iter(range(1 << 62))
    deal = lambda x: [next(at)] if isinstance(x, str) else tuple(map(deal, x[1]))
    return [deal(x) for x in items], [None] * len(items)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper, node and container: id in the wrapper and label of what holds the host's main text, from all of its pages."""
    found = stored(streams(pages.where("html IS NOT NULL").select(host_of(F.col("url")).alias("host"), "html")), "streams")
    wrapped = wrappers(found)
    slots = stored(found.where("leaf >= 0").drop("stream").join(_matched(found, wrapped), ["host", "print", "leaf"]), "slots")
    # What every page of several says at a place is part of the template.
    template = slots.groupBy("host", "slot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).where("n > 2 AND low = high").select("host", "slot")
    texts = slots.join(template, ["host", "slot"], "left_anti").select("host", "mass", "nodes")
    total = texts.groupBy("host").agg(F.sum("mass").alias("total"))
    nodes = texts.select("host", "mass", F.explode("nodes").alias("x")).groupBy("host", "x.node", "x.label").agg(F.sum("mass").alias("mass"), F.max("x.depth").alias("depth"))
    semantic = F.substring_index("label", ".", 1).isin("article", "main")
    enough = nodes.join(total, "host").where(F.col("mass") >= SHARE * F.col("total"))
    chosen = enough.groupBy("host").agg(F.max(F.struct(semantic.alias("semantic"), "depth", "mass", "label", "node")).alias("m"))
    return wrapped.join(chosen, "host").select("host", "wrapper", F.col("m.node").alias("node"), F.col("m.label").alias("container"))


def host_containers(pages: DataFrame) -> DataFrame:
    """host, container: the label of the container that holds the host's main text, from all of its pages."""
    return host_wrappers(pages).select("host", "container")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of ``pages``."""
    wrapped = stored(host_wrappers(pages), "host-wrappers")

    def run(batches):
        for b in slices(batches, "html"):
            known: dict[str | None, list | None] = {None: None}
            out = []
            for page, container, node, wrapper in zip(*(b.column(c).to_pylist() for c in ("html", "container", "node", "wrapper")), strict=True):
                if wrapper not in known:
                    known[wrapper] = loads(wrapper)
                out.append(extract(page, container, node, known[wrapper]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(wrapped, "host", "left")
    return rows.select("page_id", "url", "html", "container", "node", "wrapper").transform(in_batches, run, "page_id long, url string, text string")


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))

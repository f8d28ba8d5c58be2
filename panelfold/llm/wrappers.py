"""Main text of web pages by inferred wrappers (union-free regular expressions).

Pages of one host come from a template, with stretches that are optional or repeated and slots for text.
A page's token stream is its tags, with the attributes that name their role, and its texts as slots named
by the elements around them.  Within a page, neighbouring stretches that are alike become a repeated group;
the distinct streams of a host are then aligned one after another, and where they differ the stretch of
either side becomes an iteration of a repeated group or an optional.  The result is the host's wrapper.
Its slots are judged once: a slot is main text if its elements say so, or, where a host marks no main
element, if it is not furniture or a repeated list of links.  A page's texts are kept or left by their slot.

Texts are compared too where no element marks the main text: a block that is the same on all pages that have its slot,
``LEAST_PAGES`` different ones or more, is a string of the template and left out; one that differs anywhere is text.
Inside a marked main element names decide: there, pages of one article in several versions look like a template.

Hot hosts: streams are reduced to distinct ones before the shuffle and folded in a tree, ``_GROUP`` streams at a time, each
round written to the shared folder; blocks are compared by counts.  So no task gets more of a host than ``_GROUP`` wrappers.

Defined results: NULL and empty pages have an empty text; a page without a valid host belongs to the host
of no name; repeated pages are extracted alike; a NULL key stays NULL; other columns are kept whatever
their names, and an added column whose name is taken is an error.  No text is cut.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache
from itertools import islice

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.llm.common import by_bytes, stage, temp_name
from panelfold.operators.sizing import join_small

LEAST_PAGES = 8
_GROUP = 64  # streams of a host that one task aligns
_LONGEST_PERIOD = 64  # tokens of a stretch that may repeat; longer ones are aligned as optionals
_OPAQUE = "script|style|noscript|template|textarea|iframe|svg|select|object|math|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_OPAQUE})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|</?[a-z](?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*>|</?[a-z][^<>]*>|[^<]+|<",
    re.S | re.I,
)
_NAME = re.compile(r"</?([a-z][a-z0-9:-]*)", re.I)
_ROLE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_P = _BLOCK - {"body", "html", "head", "caption", "legend", "option", "optgroup", "summary"}
_SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Elements that never hold main text, and words in roles that name such places.
_FURNITURE = frozenset("nav aside footer form button label input head menu dialog figure".split()) - {"figure"}
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments consent cookie cookies"
    " copyright disclaimer disqus feedback footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notices"
    " pager pagination popup privacy promo promoted promotion recommended related replies reply reviews share sharing sidebar signup social"
    " sponsor sponsored subscribe tags teaser toolbar tracking warning widget widgets complementary contentinfo search alert".split()
)
# Words of the layout, which in a compound leave it to the other words what it is: "ad-box", but not "social-history".
_LAYOUT_WORDS = frozenset(
    "area bar block bottom box btn button buttons col column container content footer global group header holder icons inner item items left"
    " link links list outer page panel pane primary right row secondary section site slot text top unit wrap wrapper".split()
)
_COMMENT_WORDS = frozenset("comment comments commentlist replies reply disqus responses".split())
_MAIN = frozenset("article main".split())
_MAIN_WORDS = frozenset("main articlebody article-body article-content post-content post-body entry-content story-body main-content".split())


@lru_cache(maxsize=1 << 14)
def _symbol(name: str, roles: str) -> str:
    words = sorted({w for m in _ROLE.finditer(roles) for w in (m[2] or m[3] or m[4] or "").lower().split()}) if roles else []
    return ".".join([name, *words])


def _tag(token: str) -> tuple[str, str]:
    """(name, symbol) of an opening tag."""
    name = _NAME.match(token)[1].lower()
    rest = token[len(name) + 1 :]
    return name, _symbol(name, " ".join(m[0] for m in _ROLE.finditer(rest)) if "=" in rest else "")


def tokens(page: str):
    """(kind, symbol or text, path) of a page: kind is "<", ">" (end) or "#" (text); path names the open elements."""
    names: list[str] = []
    symbols: list[str] = []
    path = ""
    for m in _TOKEN.finditer(page):
        token = m[0]
        if token[0] != "<" or token == "<":
            yield "#", token, path
            continue
        if m[1] or token[1] in "!?":
            if m[1]:
                yield "<", m[1].lower(), path
            continue
        if token[1] == "/":
            name = _NAME.match(token)[1].lower()
            if name in names:
                k = len(names) - 1 - names[::-1].index(name)
                del names[k:], symbols[k:]
                path = "/".join(symbols)
            yield ">", name, path
            continue
        name, symbol = _tag(token)
        if name in _ENDS_P and "p" in names:
            k = len(names) - 1 - names[::-1].index("p")
            if not _BLOCK & set(names[k + 1 :]):
                del names[k:], symbols[k:]
        if name in _SIBLINGS and name in names:
            k = len(names) - 1 - names[::-1].index(name)
            if not _SIBLINGS[name] & set(names[k + 1 :]):
                del names[k:], symbols[k:]
        if name not in _VOID and not token.endswith("/>"):
            names.append(name)
            symbols.append(symbol)
        path = "/".join(symbols)
        yield "<", symbol, path


# --- wrappers: lists of symbols, ["+", items] repeated and ["?", items] optional ----------------


def stream(page: str) -> list:
    """A page's token stream, with neighbouring stretches that are alike folded into groups."""
    out: list = []
    for kind, value, path in tokens(page):
        if kind == "#":
            if value.isspace() or (out and out[-1] == "#" + path):
                continue
            out.append("#" + path)
        else:
            out.append(value if kind == "<" else "/" + value)
        _fold(out)
    return out


def _fold(out: list) -> None:
    """Fold the end of ``out`` while it repeats what stands before it."""
    folded = True
    while folded:
        folded = False
        n = len(out)
        for period in range(1, min(_LONGEST_PERIOD, n - 1) + 1):
            before = out[n - period - 1]
            if isinstance(before, list) and before[0] == "+" and before[1] == out[n - period :]:
                del out[n - period :]
                folded = True
                break
            if 2 * period <= n and out[n - 1] == before and out[n - period :] == out[n - 2 * period : n - period]:
                if period == 1 and isinstance(before, list):
                    del out[n - 1 :]
                else:
                    out[n - 2 * period :] = [["+", out[n - period :]]]
                folded = True
                break


def _like(a, b) -> bool:
    if isinstance(a, list) and isinstance(b, list):
        return a == b or (a[0] == b[0] and _opening(a) == _opening(b))
    return a == b


def _flat(item):
    if isinstance(item, list):
        for i in item[1]:
            yield from _flat(i)
    else:
        yield item


def _opening(item) -> list[str]:
    """The first two symbols: what makes two groups iterations of one."""
    return list(islice(_flat(item), 2))


def align(a: list, b: list) -> list:
    """The wrapper of everything that ``a`` or ``b`` describes."""
    if a == b:
        return a
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if _like(x[i], y[j]) else max(below[j], row[j + 1])
    out, i, j = a[:low], 0, 0
    gap_x: list = []
    gap_y: list = []
    while i < n or j < m:
        if i < n and j < m and _like(x[i], y[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out += _resolve(gap_x, gap_y)
            gap_x, gap_y = [], []
            out.append(x[i] if x[i] == y[j] else [x[i][0], align(x[i][1], y[j][1])])
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            gap_x.append(x[i])
            i += 1
        else:
            gap_y.append(y[j])
            j += 1
    return out + _resolve(gap_x, gap_y) + a[len(a) - high :]


def _resolve(x: list, y: list) -> list:
    """A mismatch: an iteration of a repeated group or one side's optional where it fits, else optionals."""
    for one, other in ((x, y), (y, x)):
        if len(one) == 1 and isinstance(one[0], list) and one[0][0] == "+" and other == one[0][1]:
            return one
    out = _optionals(x)
    for part in _optionals(y):
        k = next((k for k, known in enumerate(out) if known[1][0] == part[1][0]), None)
        if k is None:
            out.append(part)
        else:
            out[k] = ["?", align(out[k][1], part[1])]
    return out


def _optionals(gap: list) -> list:
    """A gap as optionals: those it has, and its other stretches as new ones."""
    out: list = []
    plain: list = []
    for item in gap:
        if isinstance(item, list) and item[0] == "?":
            out += [["?", plain]] if plain else []
            plain = []
            out.append(item)
        else:
            plain.append(item)
    return out + ([["?", plain]] if plain else [])


def fold_streams(streams: list[list]) -> list:
    """The wrapper of several streams, the longest first so that the others mostly leave things out."""
    ordered = sorted(streams, key=lambda s: (-len(json.dumps(s)), json.dumps(s)))
    wrapper = ordered[0]
    for s in ordered[1:]:
        wrapper = align(wrapper, s)
    return wrapper


@lru_cache(maxsize=1 << 14)
def _words(symbol: str) -> tuple[str, frozenset[str]]:
    """Element and roles.  A compound role also counts as its words, if none of them says anything else."""
    name, *roles = symbol.split(".")
    found = set(roles)
    for r in roles:
        parts = {w for w in re.split(r"[-_\d]+", r) if w}
        if parts <= _LAYOUT_WORDS | _FURNITURE_WORDS | _COMMENT_WORDS:
            found |= parts
    return name, frozenset(found)


def _judge(path: str) -> tuple[bool, bool]:
    """(in a main element, furniture) of a slot."""
    inside = furniture = False
    for symbol in path.split("/"):
        name, words = _words(symbol)
        if name in _FURNITURE or words & _COMMENT_WORDS or (name == "header" and not inside):
            furniture = True
        elif (words - {"header"} if inside else words) & _FURNITURE_WORDS and not (name in _MAIN and not words & _COMMENT_WORDS):
            furniture = furniture or inside or not words & _MAIN_WORDS and name != "body" and name != "html"
        if not inside and (name in _MAIN or words & _MAIN_WORDS):
            inside = True
            # An element left open before the main one does not make it furniture, unless it says so itself.
            if all(_words(s)[0] not in _FURNITURE and not _words(s)[1] & _COMMENT_WORDS for s in path.split("/")):
                furniture = False
    return inside, furniture


def _slots(wrapper: list, repeated: bool = False):
    for item in wrapper:
        if isinstance(item, list):
            yield from _slots(item[1], repeated or item[0] == "+")
        elif item[0] == "#":
            yield item[1:], repeated


def _names(path: str) -> set[str]:
    return {_words(s)[0] for s in path.split("/")}


def main_slots(wrapper: list) -> list[str]:
    """Paths of the wrapper's slots that hold main text."""
    return judged_slots(wrapper)[0]


def judged_slots(wrapper: list) -> tuple[list[str], bool]:
    """Paths of the wrapper's slots that hold main text, and whether elements mark them."""
    found: dict[str, bool] = {}
    for path, repeated in _slots(wrapper):
        found[path] = found.get(path, False) or repeated
    judged = {p: _judge(p) for p in found}
    if any(inside and not furniture for inside, furniture in judged.values()):
        return sorted(p for p, (inside, furniture) in judged.items() if inside and not furniture), True
    links = {p for p, repeated in found.items() if repeated and "a" in _names(p) and "p" not in _names(p)}
    kept = sorted(p for p, (_, furniture) in judged.items() if not furniture and p not in links)
    if kept:
        return kept, False
    # Every role speaks of furniture, as where a column of the layout is named after the sidebar beside it: elements alone decide.
    plain = {p: "/".join(_words(s)[0] for s in p.split("/")) for p in found}
    return sorted(p for p in found if not _judge(plain[p])[1] and p not in links and not _COMMENT_WORDS & {w for s in p.split("/") for w in _words(s)[1]}), False


def has_main(page: str) -> bool:
    """Whether a page has a main element of its own."""
    return any(kind == "<" and (_words(v)[0] in _MAIN or _words(v)[1] & _MAIN_WORDS) for kind, v, _ in tokens(page))


def blocks(page: str, slots: frozenset[str]):
    """(path, text) of the blocks of a page's texts in ``slots``; the path is that of the first text that is not blank."""
    open_: list[str] = []
    first = ""
    for kind, value, path in tokens(page):
        if kind == "#":
            if path in slots:
                first = first or ("" if value.isspace() else path)
                open_.append(value)
        else:
            name = value.split(".", 1)[0]
            if name == "br":
                open_.append("\n")
            elif name in _BLOCK and open_:
                text = " ".join(html.unescape("".join(open_)).split())
                if text:
                    yield first, text
                open_, first = [], ""
    text = " ".join(html.unescape("".join(open_)).split())
    if text:
        yield first, text


def main_text(page: str, slots: frozenset[str], template: frozenset[int] = frozenset()) -> str:
    """Blocks of the page's texts in ``slots``, parted by empty lines, without those of the template."""
    return "\n\n".join(text for path, text in blocks(page, slots) if not template or _hash(path, text) not in template)


def _hash(path: str, text: str = "") -> int:
    h = xxhash.xxh64_intdigest(f"{path}\0{text}".encode("utf-8", "surrogatepass"))
    return h - (h >> 63 << 64)


# --- Spark ------------------------------------------------------------------------------------


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, slots, marked) from rows of (host, html)."""

    def streams(batches):
        for batch in by_bytes(batches, 1):
            found = {(h, json.dumps(stream(p))) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([s for _, s in found], pa.string())], names=["host", "stream"])

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = fold_streams([json.loads(s) for s in group["stream"]])
        return pd.DataFrame({"host": group["host"].iloc[:1], "stream": [json.dumps(wrapper)]})

    found = stage(pages.mapInArrow(streams, "host string, stream string").distinct(), "streams")
    while True:
        counts = stage(found.groupBy("host").agg(F.count("*").alias("n")), "stream-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        # The groups of a round are dealt by a hash of the round too, or a group would stay together.
        part = F.pmod(F.xxhash64("stream", F.lit(most)), F.ceil(F.col("n") / _GROUP))
        dealt = join_small(found, counts, ["host"]).withColumn("part", part)
        found = stage(dealt.groupBy("host", "part").applyInPandas(fold, "host string, stream string"), "streams")

    def judge(batches):
        for batch in batches:
            judged = [judged_slots(json.loads(s)) for s in batch.column(1).to_pylist()]
            columns = [pa.array([s for s, _ in judged], pa.list_(pa.string())), pa.array([m for _, m in judged], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["host", "wrapper", "slots", "marked"])

    return found.mapInArrow(judge, "host string, wrapper string, slots array<string>, marked boolean")


def template_blocks(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, template): hashes of the blocks that are the same wherever a host has their slot, on hosts that mark no main text.

    A host of which nothing would be left, as all its blocks are the same, has none.
    """
    open_ = wrappers.where("NOT marked").select("host", "slots")

    def run(batches):
        for batch in by_bytes(batches, 1):
            rows = set()
            for h, page, slots in zip(*[c.to_pylist() for c in batch.columns]):
                of = _hash(page)
                rows |= {(h, _hash(path), _hash(path, text), of) for path, text in blocks(page, frozenset(slots or ()))}
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["host", "path", "block", "page"])

    each = join_small(pages, open_, ["host"]).select("host", "html", "slots").mapInArrow(run, "host string, path long, block long, page long")
    each = stage(each, "blocks")
    # Copies of a page are one page.
    pages_of = each.groupBy("host", "path", "page").agg(F.lit(1).alias("one")).groupBy("host", "path").agg(F.count("*").alias("pages"))
    having = each.groupBy("host", "path", "block", "page").agg(F.lit(1).alias("one")).groupBy("host", "path", "block").agg(F.count("*").alias("n"))
    same = F.col("n") == F.col("pages")
    judged = stage(having.join(pages_of, ["host", "path"]).select("host", "block", same.alias("same"), (same & (F.col("pages") >= LEAST_PAGES)).alias("fixed")), "judged-blocks")
    left = judged.groupBy("host").agg(F.bool_or(~F.col("same")).alias("differs")).where("differs").select("host")
    return judged.where("fixed").join(left, "host", "left_semi").groupBy("host").agg(F.collect_set("block").alias("template"))


def extract(df: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of its pages."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    body = F.coalesce(F.col(f"`{page}`").cast("string"), F.lit(""))
    pages = df.select(host.alias("host"), body.alias("html"))
    wrappers = stage(infer_wrappers(pages), "wrappers")
    if wrappers.where("NOT marked").head(1):
        wrappers = wrappers.join(template_blocks(pages, wrappers), "host", "left")
    else:
        wrappers = wrappers.withColumn("template", F.lit(None).cast("array<long>"))
    at_host, slots, template = (temp_name(df, f"wrapper_{c}") for c in ("host", "slots", "template"))
    known = wrappers.select(F.col("host").alias(at_host), F.col("slots").alias(slots), F.col("template").alias(template))
    rows = df.withColumn(at_host, host).join(known, at_host, "left").select(*[f"`{c}`" for c in df.columns], slots, template)
    at, last = df.columns.index(page), len(df.columns)

    def run(batches):
        for batch in by_bytes(batches, at):
            each = [[frozenset(s or ()) for s in batch.column(last + k).to_pylist()] for k in (0, 1)]
            pages = [p or "" for p in batch.column(at).to_pylist()]
            texts = [main_text(p, s, t) for p, s, t in zip(pages, *each)]
            # A page without the main element that its host's other pages have is read by its own stream.
            texts = [t or (main_text(p, frozenset(main_slots(stream(p))), of) if p and not has_main(p) else "") for t, p, of in zip(texts, pages, each[1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(texts, pa.string())], names=[*batch.schema.names[:last], out])

    return rows.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))

"""Main text of web pages by inferring a wrapper for every host.

A page is a stream of tokens: tags with their class, and text. Repeated neighbouring groups are folded into
one repeated group, from the inside out. The streams of a host's pages are aligned one after the other to a
wrapper, a regular expression without unions: where texts differ it gets a text slot, where tokens differ they
become optional, and a group that is repeated on one page is a repeated group for all. Pages without text take no part.

The wrapper decides on all pages, also inside ``article`` and ``main``: a text that stands in one place of it, repeated groups
included, on a large share of the host's different pages is left out, but for headings inside ``article`` and ``main``. Beside that,
rules for elements leave out what they name on any page: where a page has ``article`` or ``main``, text outside of it, and menus, page headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, known by their element or by the names in their
class, id or role. These names say nothing about ``html``, ``body``, ``main`` and ``article`` (except comments as articles in an
article). Names that may mean something else (``search``, ``related``) count only alone or beside a thing (``related-links``), and
not for a kind of element with most of the page's text; comments, sidebars and the like are left out however long they are.

Pages of a host with the same folded stream are one row with counts before anything is grouped by host. Wrappers are
inferred from parts of about FAN streams, as many as the host has, and merged FAN at a time in as many rounds as it takes,
so a host with a third of all pages is spread over many tasks. A wrapper beyond WIDE entries drops those on few of its
pages. Texts of such a host have a second place, which no wrapper has to hold: the tag they stand behind. It is also the place of
texts of any host that have none in the wrapper, so each text is counted. Template texts are counted over tables, not in groups; what comes back to the pages is which texts of a stream they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.session import pinned

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>"
    r"|([^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("nav footer aside form button dialog menu head".split())
MAIN = frozenset(["article", "main"])
ROOT = frozenset(["html", "body"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 th dt figcaption caption summary".split())
COMMENTS = frozenset(["comment", "comments", "commentlist"])
#: Words of a class, id or role that say what an element is for, alone or as the first or last word of a name.
PURPOSE = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent disclaimer footer menu nav navbar newsletter pagination popup sidebar signup sponsor sponsored subscribe "
    "widget complementary contentinfo notice notices".split()
)
#: Words that do so only as the whole of a class, id or role, as the last word of a name, or before one of THINGS.
PERHAPS = frozenset("banner masthead navigation promo related search share sharing toolbar".split())
THINGS = frozenset("area bar block box button buttons container form icons items links list posts stories wrapper".split())
#: Names like has-sidebar tell what else is on the page.
ABOUT = frozenset("has no with without is".split())
WORD = re.compile(r"[a-z0-9]+")
#: What the beginning of an element closes, and where looking for it stops.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), frozenset(["dl"]))),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    **dict.fromkeys(["td", "th"], (frozenset(["td", "th"]), frozenset(["tr", "table"]))),
    **dict.fromkeys(
        "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(),
        (frozenset(["p"]), frozenset(["table", "td", "th", "button"])),
    ),
}
REPEATED = re.compile(r"(.{1,12}?)\1+", re.S)
#: A text is template if it stands in one place of the wrapper on that many different pages of the host, and on that share of them.
PAGES = 3
SHARE = 0.5
#: Streams or wrappers that one task aligns.
FAN = 32
#: Beyond that many entries a wrapper drops those that less than RARE of its pages have.
WIDE = 1024
RARE = 1 / 16


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content): kind is open, close or text; comments and elements without page text are left out."""
    for m in TOKEN.finditer(page):
        name = m[3]
        if name is not None:
            yield ("close" if m[2] else "open"), name.lower(), m[4]
        elif m[5] is not None:
            yield "text", "", m[5]


def marks(attributes: str) -> tuple[str, set[str], bool]:
    """The class of a tag, the words of class, id and role that speak against main text, and whether it is hidden."""
    if "=" not in attributes and "hidden" not in attributes:
        return "", set(), False
    label, words, hidden = "", set(), False
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or "").strip("\"'").lower()
        label = value if m[1].lower() == "class" else label
        hidden = hidden or m[1].lower() == "hidden"
        words |= against(value)
    return label, words, hidden


def against(value: str) -> set[str]:
    """The words in the names of a class, id or role by which an element isn't main text."""
    names, found = value.split(), set()
    for words in map(WORD.findall, names):
        if not words or len(words) > 1 and words[0] in ABOUT:
            continue
        first, last = words[0], words[-1]
        if first in PURPOSE or last in PURPOSE:
            found.add(first if first in PURPOSE else last)
        elif len(words) == 1:
            found |= {first} & PERHAPS if len(names) == 1 else set()
        elif last in PERHAPS or first in PERHAPS and last in THINGS:
            found.add(last if last in PERHAPS else first)
    return found


def closed_by(name: str, stack: list[str]) -> int:
    """How many of the open elements are left when ``name`` begins."""
    ends, stops = CLOSES.get(name, (frozenset(), frozenset()))
    left = len(stack)
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] in stops:
            break
        left = i if stack[i] in ends else left
    return left if ends else len(stack)


def read(page: str) -> tuple[list[str], list[tuple[int, str]], list[tuple[tuple[int, ...], str]]]:
    """Of a page: its folded stream, its texts (place of their symbol in the stream, text), and its candidates.

    A candidate is a block of text with the numbers of its texts. If any lie inside ``article`` or ``main``, they are the only ones.
    """
    parsed, spared = list(tokens(page)), set()
    while True:
        stream, texts, candidates, held, total = blocks_of(parsed, spared)
        most = {k for k, n in held.items() if 2 * n > total}
        if not most:
            break
        spared |= most
    symbols, owned = folded(stream)
    place = {n: i for i, numbers in enumerate(owned) for n in numbers}
    return symbols, [(place[n], t) for n, t in enumerate(texts)], candidates


def blocks_of(parsed: list[tuple[str, str, str]], spared: set) -> tuple[list[str], list[str], list, dict, int]:
    """Stream, texts and candidates of a page, the characters under each kind of element that may be spared, and those of the page.

    A kind is an element and its class. Kinds in ``spared`` aren't left out; characters of elements that never hold main text don't
    count. Elements end where HTML ends them, also without a tag. Headings inside ``article`` and ``main`` carry no texts, so that
    they stay even if all articles of a host have them.
    """
    stream, texts = [], []
    blocks, block, numbers = [], [], []
    stack, main, out_at, doubtful, comments = [], [], None, None, False
    held, total, seen_main = {}, 0, False

    def end_block():
        text = " ".join("".join(block).split())
        if text:
            heading = bool(main) and any(x in HEADINGS for x in stack[main[-1] :])
            blocks.append((bool(main), () if heading else tuple(numbers), text))
        block.clear()
        numbers.clear()

    def cut(n):
        nonlocal out_at, doubtful
        if n < len(stack):
            end_block()
            del stack[n:]
            main[:] = [i for i in main if i < n]
            if out_at is not None and n <= out_at:
                out_at = doubtful = None

    for kind, name, content in parsed:
        if kind == "text":
            if content.isspace():
                if block and out_at is None:
                    block.append(" ")
                continue
            stream.append("#")
            texts.append(content)
            if out_at is None:
                numbers.append(len(texts) - 1)
                block.append(html.unescape(content))
            elif doubtful:
                held[doubtful] = held.get(doubtful, 0) + len(content.strip())
            total += len(content.strip()) if out_at is None or doubtful else 0
            continue
        if name not in INLINE:
            end_block()
        elif name == "br":
            block.append(" ")
        if kind == "close":
            stream.append(f"</{name}>")
            if name in stack:
                cut(len(stack) - 1 - stack[::-1].index(name))
            continue
        label, words, hidden = marks(content)
        stream.append(f"<{name} {label}>" if label else f"<{name}>")
        cut(closed_by(name, stack))
        inside = out_at is not None
        if name in MAIN:
            # words of comments speak against an article only inside of another, or beside a list of comments
            out = hidden or bool(words & COMMENTS) and (bool(main) or inside) or inside and comments
        else:
            out = name not in ROOT and (hidden or bool(words) and (name, label) not in spared)
        if name in MAIN and not out:
            # what an unclosed element left out ends here
            out_at = doubtful = None
            main.append(len(stack))
            seen_main = True
        elif not inside and name not in VOID and not content.endswith("/") and (out or name in LEFT_OUT or name == "header" and not main):
            out_at, comments = len(stack), bool(words & COMMENTS)
            only_perhaps = out and not hidden and name not in LEFT_OUT and name != "header" and words <= PERHAPS
            doubtful = (name, label) if only_perhaps else None
        if name not in VOID and not content.endswith("/") and (name not in INLINE or out_at == len(stack) or name in stack):
            stack.append(name)
    end_block()
    if any(m for m, *_ in blocks) or seen_main:
        candidates = [(n, t) for m, n, t in blocks if m]
    else:
        candidates = [(n, t) for _, n, t in blocks]
    return stream, texts, candidates, held, total


def folded(stream: list[str]) -> tuple[list[str], list[list[int]]]:
    """The stream with repeated groups as one symbol each, and the numbers of the texts that each symbol stands for."""
    code: dict[str, str] = {}
    names: dict[str, str] = {}

    def char(symbol: str) -> str:
        if symbol not in code:
            code[symbol] = chr(0x1000 + len(code) + 0xE000 * (len(code) >= 0xC800))
            names[code[symbol]] = symbol
        return code[symbol]

    line = "".join(map(char, stream))
    at, number = [], 0
    for s in stream:
        at.append([number] if s == "#" else [])
        number += s == "#"
    while True:
        out, places, end = [], [], 0
        for m in REPEATED.finditer(line):
            body = [names[c] for c in m[1]]
            symbol = body[0] if len(body) == 1 and body[0].endswith(")+") else "(" + " ".join(body) + ")+"
            out += [line[end : m.start()], char(symbol)]
            places += at[end : m.start()] + [[n for x in at[m.start() : m.end()] for n in x]]
            end = m.end()
        out.append(line[end:])
        places += at[end:]
        if end == 0:
            break
        line, at = "".join(out), places
    return [names[c] for c in line], at


def fold(stream: list[str]) -> tuple[list[str], list[int]]:
    """The folded stream, and the numbers of the texts that stay outside of groups."""
    symbols, owned = folded(stream)
    return symbols, [n for s, numbers in zip(symbols, owned, strict=True) if s == "#" for n in numbers]


def hash_of(text: str) -> int:
    return xxhash.xxh64_intdigest(" ".join(text.split())) >> 1


def repeated_with(symbols: list[tuple], groups: list[tuple[str, list[str]]]) -> list[tuple]:
    """Runs of a known group's body, even single ones, become the group."""
    for group, body in groups:
        n, out, i = len(body), [], 0
        plain = [s[0] for s in symbols]
        while i < len(symbols):
            if plain[i : i + n] == body:
                if not (out and out[-1][0] == group):
                    out.append((group, symbols[i][1], 0, 0, symbols[i][4]))
                i += n
            elif plain[i] == group and out and out[-1][0] == group:
                i += 1
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


def body_of(group: str) -> list[str]:
    """The symbols of a repeated group, which are themselves tags, texts and groups."""
    out, depth, current = [], 0, []
    for part in re.findall(r"\(|\)\+|<[^>]*>|#", group[1:-2]):
        if part == "(":
            depth += 1
            current.append(part)
        elif part == ")+":
            depth -= 1
            current.append(part)
            if not depth:
                out.append(joined(current))
                current = []
        elif depth:
            current.append(part)
        else:
            out.append(part)
    return out


def joined(parts: list[str]) -> str:
    return re.sub(r"\( ", "(", re.sub(r" \)\+", ")+", " ".join(parts)))


def groups_in(symbols: list[tuple]) -> list[tuple[str, list[str]]]:
    return [(g, body_of(g)) for g in sorted({s[0] for s in symbols if s[0].endswith(")+")})]


def align(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """One expression for both. Entries are (symbol, optional, lowest and highest hash of the texts, for slots, pages that have it)."""
    groups = groups_in(a + b)
    a, b = repeated_with(a, groups), repeated_with(b, groups)
    matcher = SequenceMatcher(None, [s[0] for s in a], [s[0] for s in b], autojunk=False)
    out = []
    for tag, i, j, k, m in matcher.get_opcodes():
        if tag == "equal":
            out += [(x[0], x[1] or y[1], min(x[2], y[2]), max(x[3], y[3]), x[4] + y[4]) for x, y in zip(a[i:j], b[k:m], strict=True)]
        else:
            out += [(s, True, low, high, pages) for s, _, low, high, pages in a[i:j] + b[k:m]]
    return out


def entries(symbols: list[str], low: list[int], high: list[int], pages: int = 1) -> list[tuple]:
    slots = iter(zip(low, high, strict=True))
    return [(s, False, *next(slots), pages) if s == "#" else (s, False, 0, 0, pages) for s in symbols]


def is_constant(symbol: str, optional: bool, low: int, high: int) -> bool:
    """Whether an entry is a text that all pages have, and all the same."""
    return symbol == "#" and not optional and low == high


def expression(wrapper: list[tuple]) -> str:
    """The wrapper as text: constant texts are ``text``, slots ``#``, optional parts end with ``?``."""
    shown = [("text" if is_constant(*e[:4]) else e[0]) + "?" * e[1] for e in wrapper]
    return " ".join(shown)


def places(wrapper: list[str], symbols: list[str]) -> list[int]:
    """For every symbol of a stream the number of the wrapper's entry it belongs to, or -1."""
    own = repeated_with([(s, n, 0, 0, 0) for n, s in enumerate(symbols)], groups_in([(s,) for s in wrapper]))
    matcher = SequenceMatcher(None, wrapper, [s[0] for s in own], autojunk=False)
    entry = {k + x: i + x for i, k, n in matcher.get_matching_blocks() for x in range(n)}
    ends = [s[1] for s in own[1:]] + [len(symbols)]
    return [entry.get(k, -1) for k, (s, end) in enumerate(zip(own, ends, strict=True)) for _ in range(s[1], end)]


def beside(symbols: list[str]) -> list[int]:
    """For every symbol of a stream the place that it has without a wrapper, a number below -1: itself and the symbol it stands behind."""
    return [-2 - (xxhash.xxh64_intdigest(f"{before} {s}") >> 2) for before, s in zip(["", *symbols], symbols)]


LOOK = "host string, stream bigint, whole bigint, symbols array<string>, at array<int>, hashes array<bigint>, pages bigint"
WRAPPER = "host string, part bigint, symbol array<string>, optional array<boolean>, low array<bigint>, high array<bigint>, support array<bigint>, pages bigint, cut boolean"


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def stream_of(symbols: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(symbols)) >> 1


def looks(pages: DataFrame) -> DataFrame:
    """Pages as host, stream (hash of the symbols), whole (of symbols and texts), symbols, at and hashes (of each text), pages.

    Pages without any text are left out: they can't tell what the template is.
    """

    def run(batches):
        for batch in batches:
            seen: dict = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                symbols, texts, _ = read(page or "")
                if not texts:
                    continue
                hashes = [hash_of(t) for _, t in texts]
                stream = stream_of(symbols)
                whole = xxhash.xxh64_intdigest(f"{stream} {hashes}") >> 1
                got = seen.setdefault((host, whole), [stream, symbols, [i for i, _ in texts], hashes, 0])
                got[4] += 1
            rows = [(host, v[0], whole, *v[1:]) for (host, whole), v in seen.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
            names = ["host", "stream", "whole", "symbols", "at", "hashes", "pages"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return pages.select("host", "html").mapInArrow(run, LOOK)


def streams(looked: DataFrame) -> DataFrame:
    """Different streams of every host: host, stream, symbols, low and high (hashes of each slot's texts), pages, part, parts.

    A part has about FAN streams.
    """
    single = F.filter(F.arrays_zip("at", "hashes"), lambda t: F.element_at("symbols", t["at"] + 1) == "#")
    each = looked.select("host", "stream", F.explode(single).alias("t")).groupBy("host", "stream", "t.at")
    slots = each.agg(F.min("t.hashes").alias("low"), F.max("t.hashes").alias("high"))
    listed = slots.groupBy("host", "stream").agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("s"))
    whole = looked.groupBy("host", "stream").agg(F.min("symbols").alias("symbols"), F.sum("pages").alias("pages"))
    low, high = (F.coalesce(F.col("s").getField(c), F.array().cast("array<bigint>")).alias(c) for c in ("low", "high"))
    found = pinned(whole.join(listed, ["host", "stream"], "left").select("host", "stream", "symbols", low, high, "pages"))
    sizes = found.groupBy("host").agg(F.ceil(F.count("*") / FAN).alias("parts"))
    return found.join(sizes, "host").withColumn("part", F.col("stream") % F.col("parts"))


def infer(found: DataFrame) -> DataFrame:
    """One wrapper per host of `streams`, from parts first and then from the wrappers of FAN parts at a time."""

    def first(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("symbols", key=lambda c: c.map(tuple))
        columns = [group[c] for c in ("symbols", "low", "high", "pages")]
        return packed(group, [entries(list(s), low, high, int(n)) for s, low, high, n in zip(*columns, strict=True)])

    def second(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("symbol", key=lambda c: c.map(tuple))
        columns = [group[c] for c in ("symbol", "optional", "low", "high", "support")]
        return packed(group, [list(zip(*r, strict=True)) for r in zip(*columns, strict=True)])

    def packed(group, parts) -> pd.DataFrame:
        wrapper, seen = parts[0], int(group["pages"].iloc[0])
        cut = "cut" in group and bool(group["cut"].any())
        for part, pages in zip(parts[1:], group["pages"].iloc[1:], strict=True):
            wrapper, seen = align(wrapper, part), seen + int(pages)
            if len(wrapper) > WIDE:
                kept = [e for e in wrapper if e[4] >= RARE * seen]
                wrapper, cut = kept, cut or len(kept) < len(wrapper)
        columns = [list(c) for c in zip(*wrapper, strict=True)] or [[], [], [], [], []]
        row = [group["host"].iloc[0], int(group["part"].iloc[0]), *columns, seen, cut]
        return pd.DataFrame([row], columns=["host", "part", "symbol", "optional", "low", "high", "support", "pages", "cut"])

    most = found.agg(F.max("parts")).first()[0] or 0
    made = pinned(found.groupBy("host", "part").applyInPandas(first, WRAPPER))
    while most > 1:
        most = -(-most // FAN)
        merged = made.withColumn("part", F.floor(F.col("part") / FAN))
        made = pinned(merged.groupBy("host", "part").applyInPandas(second, WRAPPER))
    return made


def placed(found: DataFrame, wrapper: DataFrame) -> DataFrame:
    """host, stream, entry, other: for every symbol of a stream its entry in the host's wrapper, or else its place `beside` another one.

    Where the wrapper has dropped entries, ``other`` are the places beside another symbol of them all, else it is null.
    """

    def run(streams: pd.DataFrame, wrapper: pd.DataFrame) -> pd.DataFrame:
        symbols = list(wrapper["symbol"].iloc[0]) if len(streams) else []
        cut = len(streams) > 0 and bool(wrapper["cut"].iloc[0])
        rows = []
        for host, stream, own in zip(streams["host"], streams["stream"], map(list, streams["symbols"]), strict=True):
            behind = beside(own)
            entry = [e if e >= 0 else b for e, b in zip(places(symbols, own), behind, strict=True)]
            rows.append((host, stream, entry, behind if cut else None))
        return pd.DataFrame(rows, columns=["host", "stream", "entry", "other"])

    parts = found.select("host", "part").distinct()
    dealt = pinned(wrapper.select("host", "symbol", "cut").join(parts, "host"))
    both = found.select("host", "part", "stream", "symbols").groupBy("host", "part").cogroup(dealt.groupBy("host", "part"))
    return both.applyInPandas(run, "host string, stream bigint, entry array<bigint>, other array<bigint>")


def template(looked: DataFrame, place: DataFrame) -> DataFrame:
    """host, entry, hash of the template's texts. Pages that are equal in all texts count once: copies don't make a template."""
    pages = looked.dropDuplicates(["host", "whole"]).select("host", "stream", F.arrays_zip("at", "hashes").alias("texts"))
    of = lambda where: F.transform("texts", lambda t: F.struct(F.element_at(where, t["at"] + 1).alias("entry"), t["hashes"].alias("hash")))
    both = F.when(F.col("other").isNull(), of("entry")).otherwise(F.concat(of("entry"), of("other")))
    each = pages.join(place, ["host", "stream"]).select("host", F.explode(F.array_distinct(both)).alias("t"))
    counts = each.groupBy("host", "t.entry", "t.hash").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    every = looked.select("host", "whole").distinct().groupBy("host").agg(F.count("*").alias("different"))
    return counts.join(every, "host").where(F.col("n") >= SHARE * F.col("different")).select("host", "entry", "hash")


def template_texts(place: DataFrame, constant: DataFrame) -> DataFrame:
    """host, stream, constant: the template's texts as (place in the stream, hash). Only streams with any."""
    of = lambda where: place.select("host", "stream", F.posexplode(where).alias("at", "entry"))
    each = of("entry").union(of("other")).join(constant, ["host", "entry"])
    return each.groupBy("host", "stream").agg(F.collect_set(F.struct("at", "hash")).alias("constant"))


def candidates(pages: DataFrame) -> DataFrame:
    """key, url, host, stream, and the blocks (texts as place in the stream and hash, text) of every page."""

    def run(batches):
        for batch in batches:
            streams, blocks = [], []
            for page in batch.column("html").to_pylist():
                symbols, texts, found = read(page or "")
                streams.append(stream_of(symbols))
                blocks.append([{"texts": [{"at": texts[n][0], "hash": hash_of(texts[n][1])} for n in own], "text": t} for own, t in found])
            text = pa.struct([("at", pa.int32()), ("hash", pa.int64())])
            kind = pa.list_(pa.struct([("texts", pa.list_(text)), ("text", pa.string())]))
            columns = [batch.column("key"), batch.column("url"), batch.column("host"), pa.array(streams, pa.int64()), pa.array(blocks, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "url", "host", "stream", "blocks"])

    kinds = dict(pages.dtypes)
    block = "struct<texts: array<struct<at: int, hash: bigint>>, text: string>"
    return pages.mapInArrow(run, f"key {kinds['key']}, url {kinds['url']}, host string, stream bigint, blocks array<{block}>")


def prepared(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    return pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html"))


def wrappers(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per host (lower case; pages without one share the empty host): its wrapper's parts and number of pages."""
    return infer(pinned(streams(pinned(looks(prepared(pages, key, url, page)))))).drop("part")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, text.

    Null and empty pages, and pages without main text, give the empty text. Pages without a url share one wrapper. Rows that
    repeat a key give a row each; null keys stay null. Broken markup is read as far as it goes: an element that is
    left out and never closed ends where main text begins. An empty table gives an empty result. Other columns are
    ignored.
    """
    rows = prepared(pages, key, url, page)
    looked = pinned(looks(rows))
    found = pinned(streams(looked))
    place = pinned(placed(found, infer(found)))
    constant = pinned(template_texts(place, pinned(template(looked, place))))
    joined = candidates(rows).join(constant, ["host", "stream"], "left")
    varies = lambda b: (F.size(b.texts) == 0) | (F.size(F.array_except(b.texts, F.col("constant"))) > 0)
    own = F.filter("blocks", lambda b: F.col("constant").isNull() | varies(b))
    return joined.select(
        F.col("key").alias(key), F.col("url").alias(url), F.array_join(F.transform(own, lambda b: b.text), " ").alias("text")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))

"""Main text of web pages: markup rules, and lines shared with the page of the nearest URL."""

from __future__ import annotations

import html
import re
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from isotherm.llm.batches import in_order, map_pieces
from isotherm.sources.scratch import staged

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|textarea|select|math|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)",
    re.IGNORECASE,
)
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody tfoot thead title tr ul".split()
)
_SPACED = frozenset("br td th option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("head nav footer aside form button dialog menu label fieldset legend".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar form".split())
_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu sidebar footer breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
    "newsletter subscribe subscription share sharing social related recommended comment comments disqus "
    "respond reply replies popup modal overlay toolbar pagination pager widget widgets skip".split()
)
_COMMENTS = frozenset("comment comments reply replies".split())
_MAIN = frozenset(("article", "main"))
# what the start of another block ends
_IMPLIED = {"p": _BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd"))}

#: A page that shares this part of its lines with another may be a version of it, not its sibling.
COPY_SHARE = 0.9

#: The same for pages with an article, whose lines are seldom a template.
ARTICLE_COPY_SHARE = 0.5

#: Different pages of the host that a page asks on each side.
REACH = 2

#: A line is a link line if this part of its characters is inside links.
LINK_SHARE = 0.5

#: An element with a name of its own (class, id, role) is the article's body, not furniture, from this share of its text on.
BODY_SHARE = 0.5

#: Bits of the stored rows of one alignment; larger ones are halved first.
ALIGN_BITS = 1 << 28


def _is_dropped(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the main text, by its name or its attributes."""
    if name in _DROPPED or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key == "role" and value in _ROLES:
            return True
        if key in ("class", "id"):
            words = set(re.split(r"[^a-z]+", value))
            if words & (_COMMENTS if name in _MAIN else _HINTS) or (not inside and name not in _MAIN and "header" in words):
                return True
    return False


class Line(NamedTuple):
    """A block of a page: text, whether in article or main, share of link text, whether it may be furniture there, whether an h1."""

    text: str
    inside: bool
    links: float
    named: bool
    title: bool


def lines_of(page: str) -> list[Line]:
    """The blocks of a page outside dropped elements.

    White space inside a block is one space, also for a line break; empty blocks are left out. A
    dropped element that is never closed ends where the article begins or its container ends. `named`
    marks the lines of an article inside an element with a class, id or role that holds less than
    `BODY_SHARE` of the article's text; headings and paragraphs without such an element are the article's.
    """
    out: list[tuple[str, bool, float, tuple[int, ...], bool]] = []
    text: list[str] = []
    inside = linked = links = 0
    dropping, depth = "", 0
    open_blocks: list[tuple[str, int]] = []  # name, and a number for those with a name of their own
    sizes = [0]

    def close() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                within = tuple(number for _, number in open_blocks if number)
                for number in within:
                    sizes[number] += len(joined)
                title = any(name == "h1" for name, _ in open_blocks)
                out.append((joined, inside > 0, min(1.0, linked / len(joined)), within, title))
            text.clear()
        linked = 0

    at = 0
    for token in _TOKEN.finditer(page):
        begin, end = token.span()
        if begin > at and not dropping:
            piece = page[at:begin]
            text.append(piece)
            if links:
                linked += len(piece)
        at = end
        name = token[3]
        if not name:
            continue
        name, closing = name.lower(), bool(token[2])
        if dropping:
            starts_main = name in _MAIN and not closing and dropping not in _MAIN and not inside
            ends_main = name in _MAIN and closing and dropping != name
            implied = dropping in ("p", "li") and not closing and name in _BLOCKS
            if starts_main or ends_main or implied or (closing and name in ("body", "html")):
                dropping, depth = "", 0
            else:
                if name == dropping and name not in _VOID:
                    depth += -1 if closing else 1
                    if depth == 0:
                        dropping = ""
                continue
        if closing:
            if name in _BLOCKS:
                close()
                if any(name == opened for opened, _ in open_blocks):
                    while open_blocks.pop()[0] != name:
                        pass
            if name in _MAIN:
                inside = max(0, inside - 1)
                if not inside:
                    open_blocks.clear()
            elif name == "a":
                links = max(0, links - 1)
            elif name in _SPACED:
                text.append(" ")
            continue
        if name in _BLOCKS:
            close()
        elif name in _SPACED:
            text.append(" ")
        if name not in _VOID and _is_dropped(name, token[4], inside > 0):
            dropping, depth = name, 1
            close()
        elif name in _MAIN:
            inside += 1
        elif name == "a":
            links += 1
        if inside and name in _BLOCKS and name not in _VOID and name not in _MAIN and not dropping:
            while open_blocks and name in _IMPLIED.get(open_blocks[-1][0], ()):
                open_blocks.pop()
            own = any(key.lower() in ("class", "id", "role") for key, *_ in _ATTRIBUTE.findall(token[4]))
            if own:
                sizes.append(0)
            open_blocks.append((name, len(sizes) - 1 if own else 0))
    if not dropping and at < len(page):
        text.append(page[at:])
    close()
    whole = sum(len(line[0]) for line in out if line[1])
    return [
        Line(x, main, share, any(sizes[k] < BODY_SHARE * whole for k in within), title)
        for x, main, share, within, title in out
    ]


def parsed(page: str) -> tuple[list[str], list[bool]]:
    """The lines that may be main text, and for each whether one sibling's equal line rules it out.

    A page that has an article keeps the lines inside it, of which one sibling rules out only link
    lines; on other pages all lines.
    """
    return _candidates(lines_of(page))[:2]


def _candidates(lines: list[Line]) -> tuple[list[str], list[bool], list[bool], bool]:
    """Lines, whether one page rules them out, whether two do, and whether the page has an article."""
    main = [line for line in lines if line.inside]
    if main:
        doubtful = [line.links > LINK_SHARE and not line.title for line in main]
        named = [(line.named or d) and not line.title for line, d in zip(main, doubtful)]
        return [line.text for line in main], doubtful, named, True
    return [line.text for line in lines], [True] * len(lines), [True] * len(lines), False


def address(url: str | None) -> tuple[str | None, str]:
    """Host (without www) and path; a URL that cannot be read has no host."""
    try:
        parts = urlsplit((url or "").strip())
    except ValueError:
        return None, ""
    host = parts.netloc.rpartition("@")[2].lower().removeprefix("www.")
    return host or None, parts.path


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence with `b`."""
    shared = set(a) & set(b)
    at_a = [i for i, x in enumerate(a) if x in shared]
    return [at_a[i] for i in _aligned([a[i] for i in at_a], [x for x in b if x in shared])]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    end = len(a) - tail
    inner_a, inner_b = a[head:end], b[head : len(b) - tail]
    if not inner_a or not inner_b:
        inner = []
    elif len(inner_a) * len(inner_b) > ALIGN_BITS and len(inner_a) > 1:
        middle = len(inner_a) // 2
        left = _prefix_lengths(_rows(inner_a[:middle], inner_b)[-1], len(inner_b))
        right = _prefix_lengths(_rows(inner_a[middle:][::-1], inner_b[::-1])[-1], len(inner_b))[::-1]
        cut = int((left + right).argmax())
        inner = _aligned(inner_a[:middle], inner_b[:cut])
        inner += [middle + i for i in _aligned(inner_a[middle:], inner_b[cut:])]
    else:
        rows = _rows(inner_a, inner_b, keep=True)
        inner, i, j = [], len(inner_a), len(inner_b)
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif not rows[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                inner.append(i - 1)
                i, j = i - 1, j - 1
        inner.reverse()
    return [*range(head), *[head + i for i in inner], *range(end, len(a))]


def _rows(a: list[int], b: list[int], keep: bool = False) -> list[int]:
    """Bit rows of the alignment table: a clear bit j says that column j adds one to the length."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        row = rows[-1]
        both = row & places.get(x, 0)
        row = ((row + both) | (row - both)) & full
        if keep:
            rows.append(row)
        else:
            rows[0] = row
    return rows


def _prefix_lengths(row: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def _shared_path(a: str, b: str) -> int:
    """Leading path segments that two paths have in common."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def ruled_out(own: dict, near: list[dict]) -> list[int]:
    """Places of the lines that belong to the template of the host, by the nearest different pages.

    The page with more path segments in common comes first, the closer and earlier one on ties. It
    rules out the doubtful lines that it has too. If it has nearly all lines it may be a version of
    the page, and a line goes only if another page has it as well, where there is another. Named
    lines of an article go if two of the pages have them, versions counting as one.
    """
    near = sorted(near, key=lambda x: (-_shared_path(own["path"], x["path"]), abs(x["place"] - own["place"]), x["place"]))
    n = len(own["hashes"])
    shared = [common(own["hashes"], page["hashes"]) for page in near]
    if not n or not near:
        return []
    out = {i for i in shared[0] if own["doubtful"][i]}
    if len(near) > 1 and len(shared[0]) >= COPY_SHARE * n:
        out &= set().union(*shared[1:])
    if own["article"]:
        alike = [len(x) >= ARTICLE_COPY_SHARE * n for x in shared]
        votes = [x for x, version in zip(shared, alike) if not version]
        votes.append(sorted(set().union(*[x for x, version in zip(shared, alike) if version])))
        count = np.bincount([i for x in votes for i in x], minlength=n)
        out |= {i for i in np.flatnonzero(count > 1).tolist() if own["named"][i]}
    return sorted(out)


def _parsed_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [_candidates(lines_of(page or "")) for page in batch.column("html").to_pylist()]
    places = [address(url) for url in batch.column("url").to_pylist()]
    hashes = [np.array([xxh64_intdigest(x) for x in lines], np.uint64) for lines, *_ in rows]
    keys = [
        None if host is None else xxh3_128_digest(b"\0".join((host.encode(errors="replace"), bytes([article]), x.tobytes())))
        for (host, _), (*_, article), x in zip(places, rows, hashes)
    ]
    variants = [
        None if key is None else xxh3_128_digest(key + bytes(doubtful) + bytes(named))
        for key, (_, doubtful, named, _) in zip(keys, rows)
    ]
    return pa.RecordBatch.from_pydict(
        {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "host": pa.array([h for h, _ in places], pa.string()),
            "path": pa.array([p for _, p in places], pa.string()),
            "lines": pa.array([r[0] for r in rows], pa.list_(pa.string())),
            "doubtful": pa.array([r[1] for r in rows], pa.list_(pa.bool_())),
            "named": pa.array([r[2] for r in rows], pa.list_(pa.bool_())),
            "article": pa.array([r[3] for r in rows], pa.bool_()),
            "hashes": pa.array([x.view(np.int64) for x in hashes], pa.list_(pa.int64())),
            "sequence": pa.array(keys, pa.binary()),
            "variant": pa.array(variants, pa.binary()),
        }
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of `pages` (page_id, url, html).

    Null or empty html: empty text. A null or unreadable URL: no neighbour, markup rules only.
    Repeated rows give repeated results; very long pages are whole; other columns are not read; an
    empty table gives an empty result.

    Each page is parsed once and its lines are stored. Pages of a host with the same lines are one
    sequence, which stands at its smallest path; pages with and without an article are apart. The
    sequences are brought into the order of host and path by ranges, so a host with a third of all
    pages spans many tasks; each meets the line hashes of the `REACH` sequences on either side by
    their places in that order. A ruling holds for all pages of its sequence with the same markup
    of their lines (its variant).
    """
    rows = map_pieces(
        pages.select("page_id", "url", "html"),
        "html",
        _parsed_batch,
        "page_id bigint, url string, host string, path string, lines array<string>, doubtful array<boolean>, "
        "named array<boolean>, article boolean, hashes array<bigint>, sequence binary, variant binary",
    )
    stored = staged(rows, "lines")
    known = stored.where("sequence IS NOT NULL")
    # all rows of a sequence have the same host, article and hashes, all rows of a variant the same flags
    keys = known.groupBy("sequence").agg(
        *[F.first(c).alias(c) for c in ("host", "article", "hashes")], F.min("path").alias("path")
    )
    keys = staged(keys, "sequences")
    flags = known.where(F.exists("named", lambda x: x) | F.exists("doubtful", lambda x: x))
    variants = flags.groupBy("variant").agg(*[F.first(c).alias(c) for c in ("sequence", "doubtful", "named")])
    order = in_order(
        keys.select("host", "article", "path", "sequence", F.lit(1).cast("bigint").alias("one")),
        ["host", "article", "path", "sequence"],
        ["one"],
    )
    order = order.select("sequence", F.col("one_before").alias("place"))
    page = F.struct("path", "hashes", "article", "place", "sequence").alias("page")
    met = (
        keys.join(order, "sequence")
        .where(F.size("hashes") > 0)
        .select("host", "article", F.explode(F.array([F.col("place") + d for d in range(-REACH, REACH + 1)])).alias("at"), page)
        .groupBy("host", "article", "at")
        .agg(F.collect_list("page").alias("met"))  # a page and its neighbours: 2 * REACH + 1 at most
        .withColumn("own", F.filter("met", lambda x: x["place"] == F.col("at")))
        .where(F.size("own") == 1)
        .select(F.col("own")[0]["sequence"].alias("sequence"), "at", "met")
        .join(variants, "sequence")
    )

    def rule(batches):
        for batch in batches:
            names, places = [], []
            for row in batch.to_pylist():
                own = next(x for x in row["met"] if x["place"] == row["at"])
                others = [x for x in row["met"] if x is not own]
                names.append(row["variant"])
                places.append(ruled_out({**own, "doubtful": row["doubtful"], "named": row["named"]}, others))
            yield pa.RecordBatch.from_pydict(
                {"variant": pa.array(names, pa.binary()), "shared": pa.array(places, pa.list_(pa.int32()))}
            )

    rulings = staged(
        met.mapInArrow(rule, "variant binary, shared array<int>").where(F.size("shared") > 0), "rulings"
    )
    kept = F.filter(
        "lines", lambda x, i: F.col("shared").isNull() | ~F.array_contains(F.col("shared"), i)
    )
    text = F.concat_ws("\n", kept)
    return (
        stored.join(rulings, "variant", "left")
        .select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )

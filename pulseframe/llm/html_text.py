"""Main text of HTML pages: the best-scoring contiguous part of the page's words and tags."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.words import blocks, map_rows

# Elements and names of HTML.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul".split()
)
# What these hold is never main text.
DROPPED = frozenset("nav footer aside form button dialog menu head fieldset".split())
# Dropped only outside of an article or main element: within one they can belong to it.
DROPPED_OUTSIDE = frozenset(("header", "label"))
CONTENT = frozenset(("article", "main"))
# What a head can hold; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# A marked element or form with more than this part of the page's words holds the page.
MOST_WORDS = 0.75
# A link belongs to the sentence around it if its block has this many other words, and so few linked ones for each.
LEAST_PLAIN, MOST_LINKED = 2, 4
# Parts of a class, id or role that mark the same.
MARKS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget ad ads adv advert adverts "
    "advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "gdpr alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations comment comments commentlist reply replies respond disqus discussion login search searchbox "
    "pagination pager toolbar skip hidden complementary contentinfo dialog".split()
)
COMMENTS = frozenset("comment comments reply replies".split())
# A class that starts like this tells of another part of the page.
STATES = frozenset("has with no without is not".split())
# Elements that never hold much: their names alone do not decide on what is open.
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?P<close>>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|style|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SENTENCE_END = re.compile(r"[.!?…。！？।؟]")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Weights of words and tags where no page is labelled.
DEFAULT: Mapping[str, float] = {"word": 1.0, "link word": -0.5, "outside word": -1.0, "dropped": -4.0, "tag": -0.1}
# Labelled pages: weights are kept within these, so that words stay positive and tags negative.
LEAST, MOST = 0.05, 6.0
# Weight of a tag or dropped element within an article or main element, which is content by itself.
INNER = -LEAST


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(rest)} if rest else {}


def _is_hidden(attributes: Mapping[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I))


def _is_dropped(name: str, attributes: Mapping[str, str], in_content: bool) -> bool:
    if name in DROPPED or name in DROPPED_OUTSIDE and not in_content:
        return True
    if not attributes:
        return False
    if _is_hidden(attributes):
        return True
    names = [n for key in ("class", "id", "role") for n in attributes.get(key, "").split()]
    if name in CONTENT:
        return any(n.lower() in COMMENTS for n in names)
    if name in ("html", "body"):
        return False
    parts = ([p.lower() for p in _PART.findall(n)] for n in names)
    return any(p[0] not in STATES and not MARKS.isdisjoint(p) for p in parts if p)


def tokens(html: str) -> Iterator[tuple[str, str]]:
    """(kind, value) of a page: ``word`` kinds with a run of text, ``tag`` kinds with a name.

    A tag within an article or main element is an ``inner tag``.

    Kinds of text are ``word``, ``link word`` (in a link), ``content word`` (in an article or main
    element). A dropped element is one ``dropped`` token, whatever it holds, or an ``inner dropped`` one
    within an article or main element; comments, scripts and the like are none. Unclosed elements end with what holds them, or with the page. A form or an
    element with a mark that holds the page (its only article or main elements, or MOST_WORDS) is a
    ``dropped`` token too, but what it holds is not dropped.
    """
    held: list[dict] = []
    found = list(_scan(html, frozenset(), held))
    spared = _spared(held)
    return _scan(html, spared, []) if spared else iter(found)


def _spared(held: list[dict]) -> frozenset[int]:
    """Places of the marked elements and forms that hold the page."""
    content = [e for e in held if e["content"]]
    marked = [e for e in held if not e["content"]]
    if not marked or any(e["outside"] for e in content):
        return frozenset()
    page = max((e["page"] for e in held), default=0)
    most = max(content, key=lambda e: e["end_words"] - e["words"], default=None)
    return frozenset(
        e["at"] for e in marked
        if most and e["at"] < most["at"] < e["end"] or e["end_words"] - e["words"] > MOST_WORDS * page
    )


def _scan(html: str, spared: frozenset[int], held: list[dict]) -> Iterator[tuple[str, str]]:
    """The tokens; ``held`` gets the places and words of marked elements, forms, articles and mains."""
    words, records = 0, []  # records: what is noted of each open element

    def pop() -> tuple[str, bool]:
        record = records.pop()
        if record is not None:
            record["end"], record["end_words"] = at, words
        return open_.pop()

    def tag() -> str:
        return "inner tag" if content else "tag"

    def drop() -> str:
        return "inner dropped" if content else "dropped"

    open_: list[tuple[str, bool]] = []  # name, and whether what it holds is dropped
    links = dropped = content = at = 0
    size = len(html)
    while at < size:
        lt = html.find("<", at)
        stop = size if lt < 0 else lt
        text = html[at:stop]
        m = _TOKEN.match(html, lt) if lt >= 0 else None
        if lt >= 0 and m is None:  # a bare "<" is text
            text, stop = html[at : lt + 1], lt + 1
        if text:
            words += len(text.split())
            if open_ and open_[-1] == ("head", True) and text.strip():
                dropped -= pop()[1]
        if text and not dropped:
            yield ("content word" if content else "link word" if links else "word"), text
        at = stop
        if m is None:
            continue
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if not m["close"]:  # cut off within a tag
            break
        if m["end"]:
            if name in INLINE:
                links = max(0, links - (name == "a"))
            elif any(n == name for n, _ in open_):
                while True:
                    n, gone = pop()
                    dropped -= gone
                    content -= n in CONTENT and not gone
                    if n == name:
                        break
                links = 0
                if gone:
                    continue
            if not dropped and name != "option":
                yield tag(), "/" + name
            continue
        if open_ and (
            open_[-1] == ("head", True) and name not in IN_HEAD or open_[-1] == ("option", True) and name not in INLINE
        ):
            dropped -= pop()[1]
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            if not m["rest"].endswith("/") or name not in ("svg", "iframe", "object"):
                at = end.end() if end else size
            if not dropped:
                yield tag(), name
            continue
        if name in VOID or name in INLINE and name != "a":
            if not dropped:
                yield tag(), name
            continue
        if name == "a":
            links += 1
            if not dropped:
                yield tag(), name
            continue
        attributes = _attributes(m["rest"])
        gone = name == "option" or _is_dropped(name, attributes, content > 0)
        if name == "p" or name in ("li", "td", "tr", "th", "dd", "dt", "option"):
            # these end when the next one starts; nothing hangs on it unless they are dropped
            if gone or open_ and open_[-1] == (name, True):
                if open_ and open_[-1][0] == name:
                    dropped -= pop()[1]
                if gone:
                    if not dropped:
                        yield (tag() if name == "option" else drop()), name
                    open_.append((name, True))
                    records.append(None)
                    dropped += 1
                    continue
            if not dropped:
                yield tag(), name
            continue
        if not dropped:
            yield (drop() if gone else tag()), name
        marked = gone and name not in CONTENT and (name == "form" or name not in DROPPED | DROPPED_OUTSIDE)
        marked = marked and not _is_hidden(attributes)
        gone = gone and lt not in spared
        open_.append((name, gone))
        records.append(None)
        if marked or name in CONTENT and not gone:
            records[-1] = {"at": lt, "words": words, "content": not marked, "outside": not dropped}
            held.append(records[-1])
        dropped += gone
        content += name in CONTENT and not gone
    while open_:
        pop()
    for record in held:
        record["page"] = words


def _by_sentence(found: list[tuple[str, str]]) -> dict[int, str]:
    """Keys of runs of text that their block decides on.

    Link words of a sentence, which ends with a mark and has enough other words, are words. Without
    a sentence, bars and the like between links belong to the links.
    """
    keys: dict[int, str] = {}
    block: list[int] = []
    for i, (kind, value) in enumerate([*found, ("tag", "p")]):
        if kind.endswith("word"):
            block.append(i)
        elif value.lstrip("/") in BLOCKS:
            links = [j for j in block if found[j][0] == "link word"]
            if links:
                plain = {j: _n_words(found[j][1]) for j in block if found[j][0] == "word"}
                n, linked = sum(plain.values()), sum(_n_words(found[j][1]) for j in links)
                ends = any(_SENTENCE_END.search(found[j][1]) for j in plain)
                if ends and n >= LEAST_PLAIN and n * MOST_LINKED >= linked:
                    keys.update(dict.fromkeys(links, "word"))
                else:
                    keys.update({j: "link word" for j, k in plain.items() if not k})
            block = []
    return keys


def _n_words(text: str) -> int:
    return sum(any(map(str.isalnum, w)) for w in text.split())


def _kinds(html: str) -> list[tuple[str, str, str, int]]:
    """(weight's key, kind, value, words) of each token. Where a page has an article, other text is outside."""
    found = list(tokens(html))
    has = any(k == "content word" and v.strip() for k, v in found)
    keys = {} if has else _by_sentence(found)
    out = []
    for i, (kind, value) in enumerate(found):
        if kind.endswith("word"):
            n = len(value.split())
            key = "word" if kind == "content word" else "outside word" if has else keys.get(i, kind)
            out.append((key, kind, value, n))
        else:
            known = value.lstrip("/") in BLOCKS | VOID | INLINE | RAW
            out.append((kind if kind.endswith("dropped") else f"tag {value}" if known else "tag", kind, value, 1))
    return out


def count_labelled(html: str) -> Counter:
    """(key, inside) -> number of words and tags, of a page whose article or main element labels it.

    Inside is what stands between the tags around its first and its last word.
    """
    counts: Counter = Counter()
    found = _kinds(html)
    where = [i for i, (_, kind, value, n) in enumerate(found) if kind == "content word" and n]
    if where:
        begins = [i for i, (_, kind, value, _) in enumerate(found[: where[0]]) if kind == "tag" and value in CONTENT]
        rest = enumerate(found[where[-1] :], where[-1])
        end = next((i for i, (_, _, value, _) in rest if value in ("/article", "/main")), len(found))
        for i, (key, _, _, n) in enumerate(found):
            inside = begins[-1] < i < end
            counts[key, inside] += n
            if key == "outside word":
                counts["word", False] += n
    return counts


def weights_of(counts: Mapping[tuple[str, bool], float]) -> dict[str, float]:
    """Log odds of inside against outside for each key; words at least LEAST, the rest at most -LEAST."""
    inside = sum(n for (_, i), n in counts.items() if i)
    outside = sum(n for (_, i), n in counts.items() if not i)
    weights = dict(DEFAULT)
    if not inside:
        return weights
    for key in {k for k, _ in counts}:
        odds = np.log((counts.get((key, True), 0) + 1) / (inside + 1)) - np.log((counts.get((key, False), 0) + 1) / (outside + 1))
        weights[key] = float(np.clip(odds, LEAST, MOST) if key == "word" else np.clip(odds, -MOST, -LEAST))
    return weights


def main_text(html: str | None, weights: Mapping[str, float] = DEFAULT) -> str:
    """Text of the contiguous part of the page with the greatest sum of weights, by one linear scan.

    Ties go to the first and shortest part. Character references are decoded; white space within a
    block becomes one space, and blocks are joined by a line feed. Without positive words: empty.
    """
    if not html:
        return ""
    found = _kinds(html)
    best, part, total, begin = 0.0, (0, 0), 0.0, 0
    for i, (key, kind, _, n) in enumerate(found):
        if total <= 0:
            total, begin = 0.0, i
        total += INNER if kind.startswith("inner") else n * weights.get(key, weights["tag"])
        if total > best:
            best, part = total, (begin, i + 1)
    lines: list[list[str]] = [[]]
    for _, kind, value, _ in found[part[0] : part[1]]:
        if kind.endswith("word"):
            lines[-1].append(value)
        elif value.lstrip("/") in BLOCKS:
            lines.append([])
        elif value.lstrip("/") in ("br", "td", "th"):
            lines[-1].append(" ")
    texts = (" ".join(references.unescape("".join(line)).split()) for line in lines)
    return "\n".join(t for t in texts if t)


def learn(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weights from all pages that label themselves by an article or main element.

    Counts of a bounded number of keys (kinds of words, known tags) reach the driver.
    """

    def count(batches):
        total: Counter = Counter()
        for block in blocks(batches, "html"):
            for page in block.column("html").to_pylist():
                total.update(count_labelled(page))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                pa.array([total[k] for k in keys], pa.int64()),
            ],
            names=["key", "inside", "n"],
        )

    found = pages.select(F.col(f"`{html}`").cast("string").alias("html")).filter("html is not null")
    found = found.mapInArrow(count, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n"))
    return weights_of({(r["key"], r["inside"]): r["n"] for r in found.collect()})


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of ``pages``, without the html, with ``text`` and ``n_chars`` (code points).

    A null or empty html, or one without text, gives an empty text. Repeated rows are read one by
    one; columns of ``pages`` named like the new ones are replaced.
    """
    weights = learn(pages, html)
    out = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars")])
    names = [c for c in out.columns if c != html]
    out = out.withColumns({"text": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")})

    def read(batches):
        for block in blocks(batches, html):
            texts = [main_text(page, weights) for page in block.column(html).to_pylist()]
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
            columns = [new.get(n, block.column(n)) for n in (*names, "text", "n_chars") if n not in new]
            yield pa.RecordBatch.from_arrays([*columns, new["text"], new["n_chars"]], names=[*names, "text", "n_chars"])

    columns = [f"`{c}`" for c in (*names, "text", "n_chars")]
    return map_rows(out, read, out.select(*columns).schema)

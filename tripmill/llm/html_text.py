"""Main text of web pages by tag-path ratios.

Each text block of a page has the path of block tags from the root to it. Text length and punctuation are
aggregated by path and divided by the path's blocks; the ratios of the blocks, in page order, are smoothed, and
length and punctuation are fused. Blocks whose fused ratio is above the page's threshold are content; the
smallest element that holds the content is the article (on pages with articles, each of them and each run of blocks
beside them that has content of weight), and every block in it is returned, but for the parts
that are no article by their tag, role or class: menus, notices, adverts, forms, comments and the like. A class or id
alone does not decide: the ratio of an element that holds most of the text, or has a doubtful name, can keep it. Subtrees
are weighed by their own ratios as well, whatever they are called: behind the article, siblings of one shape that each
open or close with a by-line, and whose text is far below the ratio of the text elsewhere, are readers' comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.common import importable, whole_text

# Elements whose content is no text of the page.
_RAW = "script|style|textarea|title|noscript|template|iframe|xmp|noembed|noframes"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/a-zA-Z][^>]*+>"
    r"|<[!?][^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_SPACE = re.compile(r"\s+")
# Tags that do not end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output "
    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Parts that are no article.
_ASIDE_TAGS = frozenset(
    "nav footer aside form button select option menu dialog svg canvas object audio video head fieldset datalist map".split()
)
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
# Classes and ids that name such a part. Only a whole one counts: related-work and has-sidebar name none.
_ASIDE_NAME = re.compile(
    r"(?:(?:site|page|post|entry|article|left|right|top|bottom)-)?(?:ads?|ad-?box|advert\w*|adsense|sponsor(?:s|ed)?|nav|navbar|navigation|breadcrumbs?|"
    r"side-?bar|footer|masthead|cookies?|gdpr|comments|disqus|pagination|pager)"
    r"(?:-(?:area|bar|banner|box|container|consent|content|left|links|list|menu|nav|notice|right|section|slot|thread|unit|widget|wrapper))?"
    r"|(?:site|main)-(?:header|menu|notice)|widget-?area|comment-list|skip-?link|print-?only|hidden",
    re.IGNORECASE,
)
# Words of classes that may also be given to text of the article: its ratio decides.
_DOUBTFUL_WORD = re.compile(
    r"(?:^|-)(?:ads?|ad(?:box|slot|unit)|advert\w*|promo(?:s|ted|tions?)?|sponsor(?:s|ed)?|banner|menu|side-?bar|foot|consent|"
    r"notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommend(?:ed|ations?)?|widgets?|comment(?:s|list|ers?|ary-list)?|respond|responses?|repl(?:y|ies)|talkbacks?|feedback|"
    r"thread|reviews?|discussion)(?=-|$)",
    re.IGNORECASE,
)
# A class that begins with one of these tells of the element around, or of what is missing.
_TELLS_OF_OTHERS = re.compile(r"(?:no|not|has|is|with|without)-|.*-(?:no|with|without)-", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Elements that may each hold one comment.
_UNITS = frozenset("div li section article dd figure".split())
# Who wrote something, and perhaps when: a few words, without the end of a sentence.
_BYLINE = re.compile(r"(?=.{1,80}$)[^.!?;]*[^.!?;:,\s]")
_SIGNED = re.compile(r"\d{1,4}[-/.:]\d{1,2}|\b(?:19|20)\d\d\b|\b(?:ago|said|says|wrote|writes|yesterday|reply)\b|@", re.IGNORECASE)
_NAME = re.compile(r"(?:[^\W\d_a-z][\w'’.-]*)(?: [^\W\d_a-z][\w'’.-]*){0,3}")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A name tells nothing on these: they hold the page, or are text themselves.
_UNNAMED = _HEADINGS | frozenset("html body main article p pre blockquote".split())
# A start tag ends these, if they are open inside the same parent.
_CLOSED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "body": ("head",),
}
# What bounds the search for an element that a start tag ends.
_SCOPE = frozenset("ul ol dl table div article section main td th body html blockquote".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？»”\"')]")
_SMOOTHING = (1, 2, 3, 2, 1)
# Text beside an article is kept from this part of the heaviest's weight on.
_LEAST_WEIGHT = 0.1


# Elements deeper than this stand beside each other, as in browsers.
_DEPTH = 256
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


class _Element:
    __slots__ = ("article", "aside", "depth", "doubtful", "named", "parent", "path", "shape", "tag")

    def __init__(
        self,
        tag: str,
        parent: _Element | None,
        aside: bool,
        paths: dict[tuple[int, str], int],
        name: str | None = None,
        shape: str = "",
    ) -> None:
        # The shape: what siblings of one kind have in common, beside their tag.
        self.tag, self.parent, self.shape = tag, parent, shape
        self.aside = aside or (parent is not None and parent.aside)
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.depth = 0 if parent is None else parent.depth + 1
        # The elements from the root to here whose name is one of a part that is no article.
        self.named = () if parent is None else parent.named
        self.doubtful = name == "doubtful"
        if name:
            self.named += (self,)
        # The number of the path of tags from the root; a named element has a path of its own.
        self.path = paths.setdefault((-1 if parent is None else parent.path, f"{tag} {name}" if name else tag), len(paths))


def _is_aside(tag: str, attributes: str, inside_article: bool) -> tuple[bool, str | None]:
    """Whether an element is no article by its tag, role or being hidden, and what its names say."""
    if tag in _ASIDE_TAGS or (tag == "header" and not inside_article):
        return True, None
    if not attributes or attributes.isspace():
        return False, None
    said = None
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        if hidden:
            return True, None
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in _ASIDE_ROLES:
            return True, None
        if name == "aria-hidden" and value.lower() == "true":
            return True, None
        if name in ("class", "id") and tag not in _UNNAMED:
            for word in value.replace("_", "-").split():
                if _ASIDE_NAME.fullmatch(word):
                    said = "part"
                # An id is often made of a heading's words.
                elif name == "class" and said is None and _is_doubtful(word):
                    said = "doubtful"
    return False, said


def _is_doubtful(word: str) -> bool:
    word = _CAMEL.sub("-", word)
    return _DOUBTFUL_WORD.search(word) is not None and _TELLS_OF_OTHERS.match(word) is None


def _shape(attributes: str) -> str:
    """The first class of an element: that of siblings of one kind, where others may tell odd from even."""
    for name, value, _ in _ATTRIBUTE.findall(attributes):
        if name.lower() == "class":
            return next(iter(value.strip("\"'").split()), "")
    return ""


def blocks(page: str) -> list[tuple[_Element, str]]:
    """The text blocks of a page in page order, each with the element it stands in."""
    found: list[tuple[_Element, str]] = []
    paths: dict[tuple[int, str], int] = {}
    root = here = _Element("", None, False, paths)
    parts: list[str] = []
    # Behind the last > no tag ends, and looking for one from every < would take forever.
    end = page.rfind(">") + 1

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                found.append((here, text))

    at, unclosed = 0, False
    for match in _MARKUP.finditer(page, 0, end):
        if match.start() > at:
            parts.append(page[at : match.start()])
        at = match.end()
        tag = match[3]
        if tag is None:
            text = match[0]
            if text.startswith("<!--"):
                unclosed = not text.endswith("-->")
            elif match[1]:
                unclosed = not re.search(rf"</{match[1]}\s*>\Z", text[-len(match[1]) - 64 :], re.IGNORECASE)
            continue
        tag, closes = tag.lower(), match[2] == "/"
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if closes:
            element = here
            while element is not root and element.tag != tag:
                element = element.parent
            if element is not root:
                here = element.parent
            continue
        # A block ends an open paragraph, and an item the item before it.
        ended = ("p", *_CLOSED_BY.get(tag, ()))
        element = here
        while element is not root and element.tag not in _SCOPE:
            if element.tag in ended:
                here = element.parent
            element = element.parent
        if element is not root and element.tag in ended:
            here = element.parent
        if tag in _VOID:
            continue
        if here.depth >= _DEPTH:
            here = here.parent
        aside, name = _is_aside(tag, match[4] or "", here.article)
        child = _Element(tag, here, aside, paths, name, _shape(match[4] or "") if tag in _UNITS else "")
        if not (match[4] or "").endswith("/"):
            here = child
    if not unclosed:
        tail = _UNFINISHED.search(page, max(at, end))
        parts.append(page[at : tail.start() if tail else len(page)])
    flush()
    return found


def _ratios(found: list[tuple[_Element, str]]) -> tuple[list[float], list[float]]:
    """For each block the fused ratio of its path, smoothed over its neighbours, and as it is."""
    sums: dict[int, list[float]] = {}
    for element, text in found:
        path = sums.setdefault(element.path, [0.0, 0.0, 0.0])
        path[0] += len(text)
        path[1] += len(_PUNCTUATION.findall(text))
        path[2] += 1
    length = [sums[e.path][0] / sums[e.path][2] for e, _ in found]
    points = [sums[e.path][1] / sums[e.path][2] for e, _ in found]

    def smooth(values: list[float]) -> list[float]:
        reach = len(_SMOOTHING) // 2
        out = []
        for i in range(len(values)):
            near = [
                (values[j], _SMOOTHING[j - i + reach]) for j in range(max(0, i - reach), min(len(values), i + reach + 1))
            ]
            out.append(sum(v * w for v, w in near) / sum(w for _, w in near))
        return out

    # Long text with punctuation is content; either alone is a list of links or a table.
    smoothed = [a * (1 + b) for a, b in zip(smooth(length), smooth(points))]
    return smoothed, [a * (1 + b) for a, b in zip(length, points)]


def _threshold(values: list[float]) -> float:
    """The standard deviation: some block is always above it, and if all are alike, all are."""
    mean = sum(values) / len(values)
    return (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5


def _chain(element: _Element) -> list[_Element]:
    chain = []
    while element is not None:
        chain.append(element)
        element = element.parent
    return chain[::-1]


def _outermost_article(element: _Element) -> _Element | None:
    holder = None
    while element is not None and element.article:
        if element.tag in ("article", "main"):
            holder = element
        element = element.parent
    return holder


def _without_named_parts(found: list[tuple[_Element, str]]) -> list[tuple[_Element, str]]:
    """Without the blocks in elements named as a part that is no article, as far as the blocks bear the name out.

    An element that holds most of the text, and whose blocks have a higher ratio than any text beside it, is no such
    part, unless an article beside or around it has text of its own. Where the name is doubtful, it is also none if its
    text has half of the ratio of the content elsewhere.
    """
    if not any(element.named for element, _ in found):
        return found
    smoothed, own = _ratios(found)
    least, size = _threshold(smoothed), sum(len(text) for _, text in found)
    kept = [not element.named for element, _ in found]
    beside, written = 0.0, False

    def stands(k: int) -> None:
        nonlocal beside, written
        kept[k] = True
        if found[k][0].tag not in _HEADINGS:
            beside = max(beside, own[k])
            written = written or found[k][0].article

    for k, (element, _) in enumerate(found):
        if kept[k]:
            stands(k)
    least = max(least, _half_of_content(found, own, least, [k for k in range(len(found)) if kept[k]]))
    # From the outermost named elements to the innermost.
    level, inside = 0, [k for k in range(len(found)) if not kept[k]]
    while inside:
        parts: dict[int, list[int]] = {}
        for k in inside:
            parts.setdefault(id(found[k][0].named[level]), []).append(k)
        inside, plain = [], []
        for members in parts.values():
            part = found[members[0]][0].named[level]
            ratio = _mean_of_text(found, own, members)
            holds_most = not written and ratio > beside and 2 * sum(len(found[k][1]) for k in members) > size
            if holds_most or (part.doubtful and ratio >= least):
                for k in members:
                    (inside if len(found[k][0].named) > level + 1 else plain).append(k)
        for k in plain:
            stands(k)
        level += 1
    # Names alone never leave a page without text.
    return [block for block, keep in zip(found, kept) if keep] or found


def _mean_of_text(found: list[tuple[_Element, str]], own: list[float], among: list[int]) -> float:
    """The mean ratio of the blocks that are no headings, or of all if there are only headings."""
    text = [own[k] for k in among if found[k][0].tag not in _HEADINGS] or [own[k] for k in among]
    return sum(text) / len(text)


def _half_of_content(found: list[tuple[_Element, str]], own: list[float], least: float, among: list[int]) -> float:
    """Half of the median ratio of the content among these blocks; 0 if there is none."""
    content = sorted(own[k] for k in among if own[k] >= least and found[k][0].tag not in _HEADINGS)
    return content[len(content) // 2] / 2 if content else 0.0


def _weight(text: str) -> float:
    """The fused ratio of a block by itself."""
    return len(text) * (1 + len(_PUNCTUATION.findall(text)))


def _byline(text: str) -> int:
    """2 for who wrote something with a time or the like, 1 for a bare name, 0 for other text."""
    if not _BYLINE.fullmatch(text):
        return 0
    return 2 if _SIGNED.search(text) else 1 if _NAME.fullmatch(text) else 0


def _without_threads(found: list[tuple[_Element, str]]) -> list[tuple[_Element, str]]:
    """Without readers' comments behind the text.

    A thread is a run of two or more siblings of one tag and shape that each have a by-line as first or last block, text
    and no heading. Bare names are by-lines only in a run of three or more, because lists of terms look like a pair.
    A thread goes if its text has less than half of the ratio of the content elsewhere, and no content follows
    it; with it goes what else its parent has if none of that is content, and a heading right before it.
    """
    spans: dict[int, list] = {}
    for k, (element, _) in enumerate(found):
        while element is not None:
            span = spans.get(id(element))
            if span is None:
                spans[id(element)] = [element, k, k]
            else:
                span[2] = k
            element = element.parent
    runs: dict[tuple[int, str, str], list[tuple[int, int]]] = {}
    for element, first, last in spans.values():
        if element.tag in _UNITS and element.parent is not None and last > first:
            runs.setdefault((id(element.parent), element.tag, element.shape), []).append((first, last))
    threads: list[tuple[int, list[tuple[int, int]]]] = []
    for (parent, _, _), units in runs.items():
        if len(units) < 2:
            continue
        # A by-line that one unit lacks makes the run a list of something else.
        signs = [max(_byline(found[first][1]), _byline(found[last][1])) for first, last in units]
        if min(signs) == 0 or (min(signs) == 1 and len(units) < 3):
            continue
        if any(found[k][0].tag in _HEADINGS for first, last in units for k in range(first, last + 1)):
            continue
        threads.append((parent, units))
    if not threads:
        return found
    inside = {k for _, units in threads for first, last in units for k in range(first, last + 1)}
    elsewhere = [k for k in range(len(found)) if k not in inside]
    smoothed, own = _ratios(found)
    half = _half_of_content(found, own, _threshold(smoothed), elsewhere)
    content = [k for k in elsewhere if own[k] >= half and found[k][0].tag not in _HEADINGS] if half else []
    if not content:
        return found
    gone: set[int] = set()
    for parent, units in threads:
        members = [k for first, last in units for k in range(first, last + 1)]
        # By-lines and text may have one path, so the text is weighed by itself.
        said = [_weight(found[k][1]) for k in members if not _byline(found[k][1])]
        if members[0] < content[-1] or not said or sum(said) / len(said) >= half:
            continue
        _, first, last = spans[parent]
        if first > content[-1]:
            members = list(range(first, last + 1))
        if members[0] and found[members[0] - 1][0].tag in _HEADINGS and members[0] - 1 > content[-1]:
            members.append(members[0] - 1)
        gone.update(members)
    return [block for k, block in enumerate(found) if k not in gone]


def _common(elements: list[_Element]) -> _Element:
    """The smallest element that holds all of these."""
    common = _chain(elements[0])
    for element in elements[1:]:
        chain, same = _chain(element), 0
        while same < min(len(common), len(chain)) and common[same] is chain[same]:
            same += 1
        common = common[:same]
    return common[-1]


def _inside(found: list[tuple[_Element, str]], holder: _Element, among: Iterable[int]) -> list[int]:
    return [k for k in among if holder in _chain(found[k][0])]


def _beside_articles(
    found: list[tuple[_Element, str]],
    holders: list[_Element | None],
    ratios: list[float],
    own: list[float],
    least: float,
    content: list[int],
) -> list[int]:
    """The blocks of a page whose content is, at least in part, in articles.

    The outermost articles, and each run of blocks between them, are weighed by the ratios of their content. Smoothing
    lifts what stands next to long text, so a path counts only if its own ratio reaches the threshold as well. Each
    article with such a path is kept, and each article and run with a part of the weight of the heaviest.
    """
    # What each block weighs to: its article, or the run it is in.
    groups: list[tuple[str, int]] = []
    run = 0
    for k, holder in enumerate(holders):
        run += k > 0 and (holder is None) != (holders[k - 1] is None)
        groups.append(("run", run) if holder is None else ("article", id(holder)))
    members: dict[tuple[str, int], list[int]] = {}
    for k in content:
        if own[k] >= least:
            members.setdefault(groups[k], []).append(k)
    weights = {group: sum(ratios[k] for k in inside) for group, inside in members.items()}
    heaviest = max(weights.values(), default=0.0)
    around = {id(e) for holder in {id(h): h for h in holders if h is not None}.values() for e in _chain(holder)}
    blocks_of: dict[tuple[str, int], list[int]] = {}
    for k, group in enumerate(groups):
        blocks_of.setdefault(group, []).append(k)
    kept: list[int] = []
    for group in {groups[k]: None for k in content}:
        inside = members.get(group, [])
        if group[0] == "article":
            # One long block elsewhere can lift the threshold above every block of an article.
            if inside or sum(own[k] for k in blocks_of[group]) >= _LEAST_WEIGHT * heaviest:
                kept += blocks_of[group]
        elif inside and weights[group] >= _LEAST_WEIGHT * heaviest:
            common = _common([found[k][0] for k in inside])
            # An element around an article too is not the run's own.
            kept += blocks_of[group] if id(common) in around else _inside(found, common, blocks_of[group])
    return sorted(kept)


def main_text(page: str) -> str:
    """The main text of a page; empty if it has none."""
    found = _without_named_parts([(element, text) for element, text in blocks(page) if not element.aside])
    if not found:
        return ""
    found = _without_threads(found)
    ratios, own = _ratios(found)
    least = _threshold(ratios)
    content = [k for k, ratio in enumerate(ratios) if ratio >= least]
    holders = [_outermost_article(element) for element, _ in found]
    if any(holders[k] is not None for k in content):
        kept = _beside_articles(found, holders, ratios, own, least, content)
    else:
        kept = _inside(found, _common([found[k][0] for k in content]), range(len(found)))
    return "\n\n".join(found[k][1] for k in kept)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """One row per row of ``pages``: its id, the ``keep`` columns, ``text`` and ``n_chars`` (code points).

    Blocks are in page order, white space inside a block is one space, and two line feeds stand between blocks.
    NULL and empty html, and pages with no text of their own, have empty text. Markup that is not closed or not
    well-formed ends where a browser would end it, at the latest with the page. Each row is read by itself, so
    NULL ids, repeated rows and other columns do not matter.
    """
    importable(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("row_id"),
        *(F.col(name).alias(f"k_{name}") for name in keep),
        whole_text(html_col).alias("row_html"),
    )
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            *(T.StructField(name, rows.schema[f"k_{name}"].dataType) for name in keep),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("row_html").to_pylist()]
            columns = [batch.column("row_id"), *(batch.column(f"k_{name}") for name in keep)]
            columns += [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)

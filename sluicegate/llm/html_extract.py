"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser feeds events.  Block elements end a line; each line has
a ratio of characters outside links to tags.  The ratios of a page are smoothed with a Gaussian, and a
threshold (a share of their deviation) divides the lines into content and rest.

The content lines select the region: from the whole page down, the container that holds over half of
their characters is entered (those in an article count ``ARTICLE`` times), as long as the container it lies in has no
heading or content line of its own, and no further than an article or main element.  All lines of the region
are main text, so its short paragraphs stay, but for these:

- parts that HTML itself names as something else (menus, forms, footers, asides, scripts, ...) are no lines;
- parts with a class, id or role of ``NEVER`` (adverts, comments, cookies, ...);
- within an article, parts with one of ``OFTEN`` (share, related, notice, ...) whose smoothed ratio is below the threshold;
  elsewhere parts with a class that has such a word in it, unless they hold half of the page;
- outside articles, rows of links.

Elements whose end tags HTML lets one leave out (p, li, td, option, ...) end where HTML says.

An empty or null page gives an empty text, as does one of nothing but such parts.  A page is parsed piece by
piece; nothing is cut off.  Repeated rows are judged one by one, an empty table gives no rows.  ``text`` and
``n_chars`` are written over columns so named; the other columns stay as they are."""

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "aside button canvas datalist dialog footer form head iframe menu nav noscript object script "
    "select style svg template textarea title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul".split()
)
#: Elements that a start tag ends, and those that it does not look beyond.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("optgroup", "option"), ("select",)),
}
PARAGRAPH_SCOPE = ("table", "td", "th", "caption", "button", "object", "template")

CONTAINERS = frozenset("article main section div td th blockquote figure".split())
MAIN = ("article", "main")

#: Names (class, id, role) of what is not main text wherever it stands.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement breadcrumb breadcrumbs comment comments cookie cookies disqus "
    "footer menu modal nav navbar navigation newsletter outbrain pager pagination popup promo promoted "
    "sidebar sponsor sponsored taboola".split()
)
#: Names of what often is not.
OFTEN = frozenset(
    "adv alert banner consent disclaimer feedback form gdpr header login notice notices notification "
    "promotion related replies reply respond search share sharing signup skip social subscribe toolbar widget".split()
)
ARTICLE = 3  # how much the lines of an article count against others when the region is chosen
PIECE = 1 << 20


class Line:
    """``free``: characters outside links, white space not counted."""

    __slots__ = ("text", "tags", "free", "links", "node", "main", "marks", "heading")

    def __init__(self, text, tags, free, links, state, heading):
        self.text, self.tags, self.free, self.links, self.heading = text, tags, free, links, heading
        _, self.node, self.main, self.marks = state


class Lines(HTMLParser):
    """Collects the lines of a page, the tree of its containers and its marked parts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines = []
        self.words, self.tags, self.free, self.links, self.heading = [], 0, 0, 0, False
        self.parents, self.is_main = [-1], [False]  # of containers; 0 is the page
        self.marks = []  # whether a marked part is never main text
        self.open = []  # (tag, the state around the element)
        self.state = (False, 0, False, ())  # dropped, container, within an article, marks
        self.in_link = False

    def end_line(self):
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append(Line(text, self.tags, self.free, self.links, self.state, self.heading))
        self.words, self.tags, self.free, self.links, self.heading = [], 0, 0, 0, False

    def leave(self, k):
        """Leave the k-th open element and all within it."""
        self.end_line()
        self.state = self.open[k][1]
        del self.open[k:]
        self.in_link = False

    def leave_one_of(self, tags, scope):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                self.leave(k)
                return
            if self.open[k][0] in scope:
                return

    def marked(self, attrs, main):
        """The marks an element adds."""
        names = {w for n, v in attrs if n in ("class", "id", "role") and v for w in v.lower().split()}
        if names & NEVER:
            kind = True
        elif main and names & OFTEN:
            kind = False
        elif not main and any(w in NEVER or w in OFTEN for n in names for w in re.split(r"[^a-z0-9]+", n)):
            kind = False
        else:
            return ()
        self.marks.append(kind)
        return (len(self.marks) - 1,)

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.end_line()
            if tag in PARAGRAPH_ENDS:
                self.leave_one_of(("p",), PARAGRAPH_SCOPE)
            if tag in ENDS:
                self.leave_one_of(*ENDS[tag])
        dropped, node, main, marks = self.state
        self.tags += not dropped
        self.heading = self.heading or tag in HEADINGS
        if tag == "a":
            self.in_link, self.links = True, self.links + 1
        if tag in VOID or (tag in INLINE and not attrs):
            return
        dropped = dropped or tag in DROPPED or (tag == "header" and not main)
        if tag not in ("html", "body"):
            added = () if tag in MAIN else self.marked(attrs, main)
            if added and tag in INLINE:
                self.end_line()
            marks = marks + added
        if tag in CONTAINERS:
            main = main or tag in MAIN
            self.parents.append(node)
            self.is_main.append(main)
            node = len(self.parents) - 1
        if tag in INLINE and marks == self.state[3]:
            return
        self.open.append((tag, self.state))
        self.state = (dropped, node, main, marks)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.end_line()
        self.tags += not self.state[0]
        if tag == "a":
            self.in_link = False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.leave(k)
                break

    def handle_data(self, data):
        if not self.state[0]:
            self.words.append(data)
            if not self.in_link:
                self.free += len("".join(data.split()))


def ratios(lines):
    return [line.free / max(1, line.tags) for line in lines]


def smoothed(values, sigma):
    """Gaussian smoothing over neighbouring lines; at the ends the kernel is cut and rescaled."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def deviation(values):
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def boilerplate(page, scores, threshold):
    """Whether each line is of a part that is not main text."""
    total, held = sum(len(x.text) for x in page.lines), [0] * len(page.marks)
    for line in page.lines:
        for m in line.marks:
            held[m] += len(line.text)
    out = []
    for line, score in zip(page.lines, scores):
        never = any(page.marks[m] for m in line.marks)
        often = any(2 * held[m] < total for m in line.marks)
        out.append(never or (often and (not line.main or score < threshold)))
    return out


def rows_of_links(lines):
    """Whether each line is of a run of lines that are nothing but links, two at least in all, with a sign
    between two of them at most."""
    out, run = [False] * len(lines), []
    for i, line in enumerate([*lines, None]):
        if line is not None and line.free <= line.links and line.links and not line.main:
            run.append(i)
            continue
        if sum(lines[k].links for k in run) > 1:
            for k in run:
                out[k] = True
        run = []
    return out


def region(page, content):
    """The container with the content; ``content``: whether each line is."""
    held, own = [0] * len(page.parents), [False] * len(page.parents)
    for line, chosen in zip(page.lines, content):
        own[line.node] = own[line.node] or chosen or line.heading
        node = line.node
        while chosen and node >= 0:
            held[node] += len(line.text) * (ARTICLE if line.main else 1)
            node = page.parents[node]
    children = [[] for _ in page.parents]
    for k, parent in enumerate(page.parents):
        if parent >= 0:
            children[parent].append(k)
    node = 0
    while not own[node] and not page.is_main[node]:
        best = max(children[node], key=held.__getitem__, default=None)
        if best is None or 2 * held[best] <= held[node]:
            break
        node = best
    return node


def within(page, node):
    """Whether each container lies in ``node``."""
    out = [False] * len(page.parents)
    for k, parent in enumerate(page.parents):  # parents come first
        out[k] = k == node or (parent >= 0 and out[parent])
    return out


def main_text(html, sigma=1.0, share=0.5):
    """The main text of one page."""
    page = Lines()
    html = html or ""
    for start in range(0, len(html), PIECE):
        page.feed(html[start : start + PIECE])
    page.close()
    page.end_line()
    if not page.lines:
        return ""
    scores = smoothed(ratios(page.lines), sigma)
    threshold = share * deviation(scores)
    rest = [a or b for a, b in zip(boilerplate(page, scores, threshold), rows_of_links(page.lines))]
    content = [s >= threshold and not r for s, r in zip(scores, rest)]
    if not any(content):
        content = [not r for r in rest]
    inside = within(page, region(page, content))
    return " ".join(x.text for x, r in zip(page.lines, rest) if inside[x.node] and not r)


def extract_text(pages, html="html", sigma=1.0, share=0.5):
    """Adds ``text`` (the main text) and ``n_chars`` (its code points)."""

    @F.pandas_udf("string")
    def extracted(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, sigma, share) for h in column], dtype=object)

    return pages.withColumn("text", extracted(F.col(html))).withColumn(
        "n_chars", F.length("text").cast("long")
    )

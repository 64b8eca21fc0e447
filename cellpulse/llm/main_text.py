"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut at block-level tags into flat blocks. Each block is described by its word count
and link density and those of its neighbours, and by the kind of containers around it. A
decision tree, trained on a small labelled table of blocks (``LABELLED_PAGES``), tells article
text from menus, adverts, notices, forms and reader comments.

Null or empty html gives an empty text; markup that never closes ends with the page; repeated
rows are extracted each on its own; a page without any article block gives an empty text.
Pages are handled one by one inside a task, so nothing grows with the table.
"""

import re
from html import unescape

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after",
            "inner", "article", "boiler", "reply", "page_article", "heading"]

# Names of HTML elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details
    dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr
    html legend li main menu nav ol option p pre search section select summary table tbody td
    textarea tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("""nav header footer aside form menu dialog button select textarea
    fieldset search""".split())
KEPT_OPEN = frozenset("""article main section div nav header footer aside form menu dialog button
    select textarea fieldset search ul ol dl table td figure details blockquote h1 h2 h3 h4 h5 h6
    a""".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
# End of fixed values.

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|iframe|object|title|"
    r"""svg(?!(?=[\s/>])(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+(?<=/)>))(?=[\s/>])"""   # not <svg .../>
    r"""(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+>.*?(?:</\1\s*>|\Z)"""
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|</?([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>"""   # a quote opens after =
    r"|</?([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.I)
_BOILER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr"
    r"|notices?|alert|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead"
    r"|topbar|share|sharing|social|related|recommended|more-stories|newsletter|subscribe"
    r"|subscription|popup|modal|overlay|widget|toolbar|pagination|pager|login|signin|signup|search"
    r"|skip|complementary|contentinfo|dialog|teaser|outbrain|taboola|paywall|disclaimer|legal"
    r"|copyright)(?:$|[\s_-])", re.I)
_REPLY_NAME = re.compile(
    r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies|reply|discussion|responses)"
    r"(?:$|[\s_-])", re.I)
_ARTICLE_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|articlebody|main|content|post|entry|story|maintext|body)(?:$|[\s_-])",
    re.I)


def _kind(tag: str, attributes: str, in_article: bool) -> tuple:
    """(kind, reply): kind 1 article, -1 boilerplate, 0 neither."""
    names = ""
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            names += " " + value
        elif (name == "hidden" or name == "aria-hidden" and value.lower() == "true"
              or name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return -1, False
    reply = bool(names) and bool(_REPLY_NAME.search(names))
    if reply:
        return -1, True
    if tag in ("article", "main"):
        return 1, False
    if tag in BOILER_TAGS and not (tag == "header" and in_article):
        return -1, False
    bad = bool(names) and bool(_BOILER_NAME.search(names))
    good = bool(names) and bool(_ARTICLE_NAME.search(names))
    if tag == "header" or bad == good:
        return 0, False
    return (-1 if bad else 1), False


def blocks(html: str) -> list:
    """Flat blocks of a page in order: (text, words, linked words, inner kind, in article,
    in boilerplate, in reader comments, heading)."""
    out, stack, parts = [], [], []
    linked = False

    def flush():
        if parts:
            text = " ".join(unescape("".join(p for p, _ in parts)).split())
            if text:
                total = len(text.split(" "))
                links = sum(len(unescape(p).split()) for p, a in parts if a)
                kinds = [k for _, k, _ in stack if k]
                out.append((text, total, min(links, total), kinds[-1] if kinds else 0,
                            int(1 in kinds), int(any(k < 0 and t != "form" for t, k, _ in stack)),
                            int(any(r for _, _, r in stack)),
                            int(any(t in HEADINGS for t, _, _ in stack))))
            parts.clear()

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            parts.append((html[at:token.start()], linked))
        at = token.end()
        if token[1]:
            flush()
            continue
        tag = (token[2] or token[4] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append((" ", False))
            continue
        closing = token[0].startswith("</")
        if tag in BLOCK_TAGS:
            flush()
        if tag == "a":
            linked = not closing
        if tag not in KEPT_OPEN:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif not token[0].endswith("/>"):
            # An open paragraph, item or heading ends where the next block begins.
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"
                          or stack[-1][0] in HEADINGS):
                stack.pop()
            inside = any(k == 1 for _, k, _ in stack)
            stack.append((tag, *_kind(tag, token[3] or token[5] or "", inside)))
    if at < len(html):
        parts.append((html[at:], linked))
    flush()
    return out


def describe(found: list) -> list:
    """One feature row per block, in the order of ``FEATURES``."""
    has_article = int(any(b[4] for b in found))
    share = [b[2] / b[1] for b in found]
    rows = []
    for i, b in enumerate(found):
        before = (found[i - 1][1], share[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], share[i + 1]) if i + 1 < len(found) else (0, 0.0)
        rows.append((b[1], share[i], *before, *after, b[3], b[4], b[5], b[6], has_article, b[7]))
    return rows


# The labelled table: blocks that start with a paragraph sign are article text, the others are
# not. A number in braces stands for that many words.
LABELLED_PAGES = [
    "<nav><ul><li><a>{1}</a><li><a>{2}</a><li><a>{1}</a></ul></nav><div class=ad>{12}</div>"
    "<article><h1>§{7}</h1><p>§{40}<p>§{1}<p>§{3}<p>§{90}</article><footer>{9}</footer>",
    "<header><a>{3}</a><p>{6}</header><main><h1>§{5}</h1><p>§{60}<p>§{22}<h2>§{2}</h2><p>§{2}"
    "<aside><p>{30}<a>{4}</a></aside><p>§{35}</main><footer><p>{25}<a>{2}</a></footer>",
    "<div class=cookie-notice><p>{28}<button>{2}</button></div><article><p>§{4}<p>§{120}"
    "<ul><li>§{6}<li>§{9}</ul><div class=ad>{18}</div><p>§<a>{5}</a> {14}</article>"
    "<section id=comments><article><p>{33}</article><article><p>{4}</article></section>",
    "<div class=menu><a>{1}</a> <a>{1}</a> <a>{2}</a></div><div><h1>§{6}</h1><p>§{50}<p>§{44}"
    "<p>§{7}<p>§{61}</div><div><a>{5}</a></div><div><a>{6}</a></div><div>{4}</div>",
    "<div><a>{2}</a> <a>{1}</a> <a>{1}</a></div><div><p>§{33}<p>§{27}<p>§{40}</div>"
    "<form><p>{20}<label>{2}</label></form><div class=comments><p>{45}<p>{20}</div>"
    "<div>{3} <a>{3}</a> <a>{2}</a></div>",
    "<aside><h3>{3}</h3><p>{50}</aside><article><h1>§{9}</h1><p>§{15}<p>§{1}</article>"
    "<div class=sidebar><p>{40}</div><div class='newsletter'><p>{16}</div><p>{6}",
    "<article><header><h1>§{8}</h1><p>§{5}</header><p>§{70}<blockquote>§{20}</blockquote>"
    "<footer><p>{11}</footer></article><div class='comment'><p>{60}</div><p>{22}",
    "<div id=content><h1>§{4}</h1><p>§{3}<p>§{52}<p>§{2}</div><div class=related><a>{7}</a> "
    "<a>{8}</a></div><div class='legal'><p>{48}</div>",
    "<p>§{20}<p>§{31}<p>§{5}<p>§{44}",
    "<ul><li><a>{1}</a><li><a>{2}</a><li><a>{2}</a></ul><p>§{80}<p>§{12}<p>§{64}<p><a>{2}</a> {1}",
    "<table><tr><td><a>{2}</a><td><a>{2}</a></table><table><tr><td>§{55}<td>§{34}</table>"
    "<div class=banner>{9}</div><div><a>{3}</a></div>",
    "<form><input><p>{14}</form><main><p>§{1}<p>§{2}<p>§<a>{4}</a><p>§{3}</main><nav>{30}</nav>",
    "<div class='ad'>{60}</div><div class='ad'>{2}</div><article><p>§{1}</article><nav><p>{2}</nav>"
    "<section class=reply><p>{70}<p>{1}</section><footer>{70}</footer><aside>{1}</aside>",
    "<div class=notice><p>{55}<p>{8}</div><div class=post><p>§{9}<p>§{41}<p>§{2}<form><p>{9}</form>"
    "</div><p>{35}<p>{2}",
    "<article><p>§{200}</article><p>{40}<p>{15}<div><a>{2}</a></div>",
    "<form><nav><a>{2}</a><a>{3}</a></nav><article><p>§{3}<p>§{30}<p>§{1}</article><p>{8}</form>",
    "<aside><article><h2>{4}</h2><p>{20}<p>{3}</article></aside><article><p>§{24}</article>",
    "<main><p>§{12}<p>§{26}</main><div><p>{28}<p>{5}</div><p><a>{6}</a>",
]


def labelled_blocks() -> list:
    """(label, features) of every block of the labelled pages."""
    rows = []
    for page in LABELLED_PAGES:
        html = re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), page)
        marks = [b[0].startswith("§") for b in blocks(html)]
        rows += list(zip(marks, describe(blocks(html.replace("§", "")))))
    return rows


def fit_tree(spark: SparkSession, depth: int = 8) -> tuple:
    """Train the tree on the labelled table; returns nested (feature, threshold, left, right)
    tuples, or a bool at a leaf."""
    frame = spark.createDataFrame(
        [(float(y), Vectors.dense([float(v) for v in x])) for y, x in labelled_blocks()],
        ["label", "features"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, seed=1).fit(frame)

    def export(node):
        if node.numDescendants() == 0:
            return node.prediction() > 0.5
        split = node.split()
        return (split.featureIndex(), split.threshold(), export(node.leftChild()),
                export(node.rightChild()))
    return export(model._call_java("rootNode"))


def is_main(tree, row) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if row[feature] <= threshold else right
    return tree


def page_text(html, tree) -> str:
    found = blocks(html or "")
    return "\n".join(b[0] for b, row in zip(found, describe(found)) if is_main(tree, row))


def extract(pages: DataFrame, keys: list, html: str = "html", tree=None) -> DataFrame:
    """``keys`` columns plus ``text`` and ``n_chars`` (code points) of every page."""
    tree = tree or fit_tree(pages.sparkSession)
    slim = pages.select(*[f"`{k}`" for k in keys], f"`{html}`")
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", text string, n_chars bigint"

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [page_text(h, tree) for h in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keys))]
                + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keys, "text", "n_chars"])
    return slim.mapInArrow(run, schema)

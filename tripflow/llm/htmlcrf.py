"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text without a block-level tag inside. Each block is described by the tags,
roles and class words of its ancestors and by its text. Two labels, main text or not, form a chain; weights are fitted
by maximum likelihood on labelled pages and pages are decoded by Viterbi.

Labelled pages come from a bounded sample of the pages themselves: each sampled page with landmarks of main text is
labelled by them (`weak_labels`), once as it is and once as if it had none, and its text is set anew into layouts whose
labels are known by construction (`layout`). Pages without landmarks are not labelled. Layouts of fixed texts are always
among the labelled pages, so that a table without landmarks has a model too; a table without pages has none.
"""

from __future__ import annotations

import html as html_text
import random
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns_by_arrow

#: Bound on the pages used for fitting, picked by a hash of page_id; layouts made of each; blocks of a training chain.
TRAIN_PAGES, LAYOUTS, CHAIN = 200, 3, 60
#: Layouts made of the fixed texts.
FIXED_LAYOUTS = 120
ROUNDS, RATE, PENALTY = 120, 0.15, 1e-4
SEED = 5

# Elements as HTML defines them. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = "script|style|noscript|template|iframe|svg|math"
#: Start tags that end an open element of these names, up to the nearest of the others.
P_ENDS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: What stands in a tag up to its end. A quote opens a value behind = only, and only if it is closed.
INSIDE = r"(?:[^>=]++|=\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+|))*+"
TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:svg|math)(?=[\s/>]){INSIDE}(?<=/)>|<({RAW})(?=[\s/>]){INSIDE}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({INSIDE})>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|itemprop|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[a-zA-Z]+")
#: Kinds of class words, each a feature of its own. A word is of a kind if it is made of the kind's words and FILL only.
FILL = "area|bar|block|box|container|group|holder|inner|item|links?|list|outer|panel|row|section|wrap(?:per)?"
KINDS = tuple((name, re.compile(f"(?:{FILL})*(?:{words})(?:{FILL}|{words})*")) for name, words in (
    ("comment", r"comments?|commentators?|reply|replies|discuss(?:ions?)?|disqus|respond|feedback"),
    ("ad", r"ads?|advert(?:s|ising|isements?)?|sponsor(?:s|ed)?|promo(?:s|tions?|ted)?|banners?|dfp|taboola|outbrain"),
    ("menu", r"nav(?:igation)?|(?:sub)?menus?|(?:bread)?crumbs?|pagination|pager|tool|toolbar|tabs?"),
    ("foot", r"foot|footer|copyright|legal|imprint"),
    ("side", r"side|aside|widgets?|related|recommend(?:s|ed|ations?)?|more|popular|trending|tags?|shar(?:e|es|ing)|social"),
    ("notice", r"cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletters?|subscri(?:be|ptions?)|signup|login|paywall"),
    ("head", r"head|header|mast|masthead|logo|top|site"),
    ("form", r"forms?|search|fields?|inputs?"),
    ("main", r"contents?|articles?|posts?|entry|entries|story|stories|main|body|texts?"),
))
#: Class names that begin so tell what a page or wrapper holds, not what it is.
HOLDS = ("has-", "has_", "with-", "with_", "no-", "no_", "without-", "without_")
LANDMARKS = frozenset(["in:article", "in:main", "role:main", "itemprop:articlebody"])
NOT_MAIN = frozenset([
    "in:nav", "in:footer", "in:aside", "in:form", "in:head", "in:button", "in:select", "in:dialog", "hidden",
    *(f"kind:{k}" for k, _ in KINDS if k not in ("main", "head")),
])


@dataclass
class Block:
    text: str
    features: list[str]


def _element_features(tag: str, attributes: str) -> tuple[str, ...]:
    found = [f"in:{tag}"]
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id"):
            if tag in ("html", "body"):
                continue  # of the page, not of a part of it
            for word in (w for part in value.split() if not part.startswith(HOLDS) for w in WORD.findall(part)):
                found.append(f"word:{word}")
                found += [f"kind:{kind}" for kind, pattern in KINDS if pattern.fullmatch(word)]
        elif name in ("role", "itemprop"):
            found.append(f"{name}:{value}")
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            found.append("hidden")
    return tuple(found)


def _text_features(text: str, linked: int, tag: str) -> list[str]:
    share = linked / len(text)
    return [
        "any", f"tag:{tag}", f"size:{0 if len(text) < 25 else 1 if len(text) < 100 else 2}",
        f"links:{0 if not linked else 1 if share < 0.5 else 2}", *(["mark"] if "©" in text else []),
    ]


def _without_landmarks(features: list[str]) -> list[str]:
    """Features of a block as if its page had no landmark of main text."""
    return [f for f in features if f not in LANDMARKS]


def _open(m: re.Match) -> bool:
    """Whether a comment, character data or raw element has no end."""
    text = m[0]
    if text.startswith("<!--"):
        return not text.endswith("-->")
    if text.startswith("<![CDATA["):
        return not text.endswith("]]>")
    return bool(m[1]) and not re.search(rf"</{m[1]}\s*>\Z", text, re.I)


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order, with references decoded and white space as single spaces; blocks without text are left out."""
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # open elements: name, features of it and all around it
    run: list[str] = []
    links: list[str] = []
    in_link = 0

    def close() -> None:
        if run:
            text = " ".join(html_text.unescape("".join(run)).split())
            if text:
                linked = len(" ".join(html_text.unescape("".join(links)).split())) if links else 0
                tag = next((name for name, _ in reversed(stack) if name not in INLINE), "none")
                around = stack[-1][1] if stack else ()
                found.append(Block(text, [*around, *_text_features(text, min(linked, len(text)), tag)]))
            run.clear()
            links.clear()

    at, last, end = 0, None, page.rfind(">") + 1  # no tag ends behind the last >, so none is looked for there
    for last in TAG.finditer(page, 0, end):
        m = last
        if m.start() > at:
            run.append(page[at : m.start()])
            if in_link:
                links.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name == "br":
            run.append(" ")
        elif name in INLINE and name != "a":
            continue  # neither cuts text nor describes it
        elif name == "a":
            in_link = 0 if m[2] else 1
        elif m[2]:
            close()
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
        else:
            close()
            in_link = 0
            ends, scope = ENDS.get(name, ((), ()))
            if name in P_ENDS:
                ends, scope = ("p",), P_ENDS - {"p"}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in scope:
                    break
            if name not in VOID:
                around = stack[-1][1] if stack else ()
                stack.append((name, around + tuple(f for f in _element_features(name, m[4]) if f not in around)))
    if not (last and at == end and _open(last)):  # what is still open takes the rest of the page
        opened = [x for x in (page.find("<!--", at), page.find("<![CDATA[", at)) if x >= 0]
        run.append(page[at : min(opened, default=len(page))])
    close()
    return found


# ---------------------------------------------------------------- labelled pages



def weak_labels(page: list[Block]) -> list[int]:
    """1 for blocks inside an article or main element (the page's landmarks) and outside of navigation, forms and the like.

    Labels of pages to learn from only: what is learned are weights of tags, roles, class words and text, and pages are
    decoded by these alone.
    """
    return [int(not LANDMARKS.isdisjoint(b.features) and NOT_MAIN.isdisjoint(b.features)) for b in page]


WRAPS = (
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div class="post-body">', "</div>"),
    ('<section class="entry">', "</section>"), ('<div role="main">', "</div>"), ('<div id="main"><article class="story">', "</article></div>"),
    ("<div>", "</div>"), ('<div id="page"><div>', "</div></div>"), ("<section>", "</section>"), ("", ""),
)
CLUTTER = {
    "outside": (
        "<nav><ul>{links}</ul></nav>", '<div class="menu">{links}</div>', "<header><p>{short}</p></header>", '<header class="site-header"><h2>{short}</h2><nav>{links}</nav></header>',
        "<footer>{short}</footer>", '<div class="footer"><p>{long}</p></div>', "<footer><p>{long}</p><p>&copy; {short}</p></footer>",
    ),
    "anywhere": (
        "<aside><h3>{short}</h3><p>{long}</p></aside>", '<div class="sidebar"><p>{long}</p><ul>{links}</ul></div>', '<div class="ad">{long}</div>', '<div class="advert"><p>{long}</p></div>',
        '<ins class="ads">{short}</ins>', '<div class="cookie-notice"><p>{long}</p><button>{short}</button></div>', '<div class="notice">{long}</div>', '<div id="newsletter"><form><p>{long}</p><input><button>{short}</button></form></div>',
        "<form><label>{short}</label><select><option>{short}</select><p>{long}</p></form>", '<section class="comments"><h3>{short}</h3><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p><p>{longer}</p></div></section>',
        '<div id="comments"><ol><li><p>{longer}</p></li><li><p>{long}</p></li></ol></div>', '<div class="related"><h4>{short}</h4><ul>{links}</ul></div>', '<div role="complementary"><p>{long}</p></div>', '<p hidden>{long}</p>',
    ),
}
MAIN_TAGS = ("p", "p", "p", "p", "h2", "blockquote", "li", "pre", "td", "div")


def layout(texts: list[str], seed: int) -> list[tuple[Block, int]]:
    """Blocks and labels of one made page: texts as main text in one of the wraps, among clutter made of the same words."""
    rng = random.Random(seed)
    words = [w for t in texts for w in t.split()] or ["text"]

    def some(n: int) -> str:
        at = rng.randrange(len(words))
        return html_text.escape(" ".join((words[at:] + words)[:n]), quote=False)

    def clutter(kind: str) -> str:
        form = rng.choice(CLUTTER[kind])
        return re.sub(r"\{(\w+)\}", lambda m: "".join(f'<li><a href="/">{some(2)}</a></li>' for _ in range(rng.randint(2, 6))) if m[1] == "links" else some({"short": rng.randint(1, 5), "long": rng.randint(6, 40), "longer": rng.randint(20, 120)}[m[1]]), form)

    start, end = rng.choice(WRAPS)
    parts: list[tuple[str, int]] = [(clutter("outside" if rng.random() < 0.6 else "anywhere"), 0) for _ in range(rng.randint(1, 4))]
    parts.append((start, 0))  # markup alone makes no block
    for k, t in enumerate(texts):
        if rng.random() < 0.15:
            parts.append((clutter("anywhere"), 0))
        tag = "h1" if k == 0 and rng.random() < 0.7 else rng.choice(MAIN_TAGS)
        parts.append((f"<{tag}>{html_text.escape(t, quote=False)}</{tag}>", 1))
        if rng.random() < 0.2:
            parts.append((f"<p>{some(rng.randint(1, 3))}</p>", 1))
    if rng.random() < 0.5:
        parts.append((clutter("anywhere"), 0))
    parts.append((end, 0))
    parts += [(clutter("outside" if rng.random() < 0.6 else "anywhere"), 0) for _ in range(rng.randint(1, 4))]
    # a private-use character tells main text until the blocks are cut
    sign = "\ue000"
    made = blocks("<body>" + "".join(p.replace(">", ">" + sign, 1) if label else p for p, label in parts) + "</body>")
    rows = []
    for b in made:
        label = int(sign in b.text)
        b.text = b.text.replace(sign, "").strip()
        if b.text:
            rows.append((b, label))
    return rows


#: Texts of the layouts that do not depend on a table.
FIXED_TEXTS = (
    "A walk along the river",
    "The path begins behind the old mill, where the water is slow and the banks are low enough to sit on. In the early morning there is hardly anybody about.",
    "Further on the trees stand closer together.",
    "After about an hour the valley opens, and on a clear day the hills to the north can be seen. Most people turn back here, but the path goes on for several miles, "
    "past two farms and a small chapel whose door is never locked.",
    "Bring water and a coat",
    "There is a bus in the afternoon, and the driver will stop anywhere on the road if a hand is raised in time.",
)


def labelled(pages: list[str | None]) -> list[tuple[list[list[str]], list[int]]]:
    """Chains of features and labels: of the pages with landmarks, of layouts of their texts and of the fixed layouts.
    No pages give none."""
    chains = []

    def add(texts: list[str], seed: int) -> None:
        rows = layout(texts, seed)
        chains.append(([b.features for b, _ in rows], [y for _, y in rows]))

    for k, html in enumerate(pages):
        page = blocks(html)
        labels = weak_labels(page)
        if not any(labels):
            continue
        chains.append(([b.features for b in page], labels))
        chains.append(([_without_landmarks(b.features) for b in page], labels))
        texts = [b.text for b, y in zip(page, labels, strict=True) if y][:CHAIN]
        for m in range(LAYOUTS):
            add(texts, SEED + k * LAYOUTS + m)
    for m in range(FIXED_LAYOUTS if pages else 0):
        add(list(FIXED_TEXTS[m % 2 : 2 + m % 5]), -1 - m)
    return chains


# ---------------------------------------------------------------- the chain


@dataclass(frozen=True)
class Model:
    """weights: label scores by feature; step[a][b]: score of label b behind a; first: scores at the start."""

    weights: dict[str, tuple[float, float]]
    step: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(x, axis=axis)


def fit_chains(chains: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS) -> Model:
    """Maximum likelihood with a small penalty, by gradient steps over all chains at once (forward-backward for the
    expected counts). Chains are lists of feature lists with labels. No chain gives a model that labels nothing."""
    names = sorted({f for feats, _ in chains for fs in feats for f in fs})
    if not names:
        return Model({}, ((0.0, 0.0), (0.0, 0.0)), (1.0, 0.0))
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(chains), max(len(c[1]) for c in chains)
    length = np.array([len(c[1]) for c in chains])
    label = np.zeros((n, longest), dtype=np.int64)
    row, col = [], []
    for k, (feats, labels) in enumerate(chains):
        label[k, : len(labels)] = labels
        for t, fs in enumerate(feats):
            row += [k * longest + t] * len(fs)
            col += [number[f] for f in fs]
    row, col = np.array(row), np.array(col)
    inside = np.arange(longest) < length[:, None]
    one_hot = np.eye(2)[label] * inside[..., None]
    pairs = np.einsum("kta,ktb->ab", one_hot[:, :-1], one_hot[:, 1:])
    size = len(names) * 2 + 6
    x, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for r in range(1, rounds + 1):
        w, step, first = x[: -6].reshape(-1, 2), x[-6:-2].reshape(2, 2), x[-2:]
        score = np.stack([np.bincount(row, w[col, y], minlength=n * longest) for y in (0, 1)], axis=-1).reshape(n, longest, 2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = first + score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + step, 1) + score[:, t]
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            nxt = _log_sum(step + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], nxt, 0.0)
        total = _log_sum(ahead[np.arange(n), length - 1], 1)
        share = np.exp(ahead + behind - total[:, None, None]) * inside[..., None]
        joint = np.exp(ahead[:, :-1, :, None] + step + (score + behind)[:, 1:, None, :] - total[:, None, None, None])
        joint *= inside[:, 1:, None, None]
        error = (one_hot - share).reshape(-1, 2)
        grad = np.concatenate([
            np.stack([np.bincount(col, error[row, y], minlength=len(names)) for y in (0, 1)], axis=-1).ravel(),
            (pairs - joint.sum(axis=(0, 1))).ravel(), (one_hot[:, 0] - share[:, 0]).sum(axis=0),
        ]) / inside.sum() - PENALTY * x
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        x = x + RATE * (mean / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-8)
    w, step, first = x[: -6].reshape(-1, 2), x[-6:-2].reshape(2, 2), x[-2:]
    return Model({f: (float(w[i, 0]), float(w[i, 1])) for f, i in number.items()}, tuple(map(tuple, step.tolist())), tuple(first.tolist()))


def viterbi(model: Model, features: Iterable[list[str]]) -> list[int]:
    """Best labels of a chain; ties go to label 0."""
    get, none = model.weights.get, (0.0, 0.0)
    (s00, s01), (s10, s11) = model.step
    best: tuple[float, float] | None = None
    back: list[tuple[int, int]] = []
    for fs in features:
        e0 = e1 = 0.0
        for f in fs:
            w = get(f, none)
            e0 += w[0]
            e1 += w[1]
        if best is None:
            back.append((0, 0))
            best = (model.first[0] + e0, model.first[1] + e1)
        else:
            a, b = best[0] + s00, best[1] + s10
            c, d = best[0] + s01, best[1] + s11
            back.append((int(b > a), int(d > c)))
            best = (max(a, b) + e0, max(c, d) + e1)
    if best is None:
        return []
    y = int(best[1] > best[0])
    labels = []
    for k in range(len(back) - 1, -1, -1):
        labels.append(y)
        y = back[k][y]
    return labels[::-1]


def main_text(model: Model, page: str | None) -> str:
    found = blocks(page)
    labels = viterbi(model, [b.features for b in found])
    return "\n".join(b.text for b, y in zip(found, labels, strict=True) if y)


def fit(pages: DataFrame, html: str = "html", page_id: str = "page_id", train_pages: int = TRAIN_PAGES) -> Model:
    """A model from about train_pages pages at most, picked by a hash of page_id, LAYOUTS made pages for each that
    has landmarks, and the fixed layouts."""
    usable = pages.where(F.col(html).isNotNull() & F.col(page_id).isNotNull())
    share = min(1.0, train_pages / max(usable.count(), 1)) * (1 << 20)
    key = F.xxhash64(F.col(page_id).cast("string"), F.lit(SEED))
    picked = usable.where(F.pmod(key, F.lit(1 << 20)) < F.lit(share)).orderBy(key, html).limit(2 * train_pages)
    chains = labelled([r["html"] for r in picked.select(F.col(html).alias("html")).collect()])
    cut = [(f[at : at + CHAIN], y[at : at + CHAIN]) for f, y in chains for at in range(0, len(y), CHAIN)]
    return fit_chains(cut)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """pages with text: the main text, blocks joined by line ends, empty if there is none (or html is null or empty).

    Rows are independent: nothing is shuffled, repeated rows get equal results, extra columns stay, a column named text
    is replaced. Nothing of a page is cut off.
    """
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.step, model.first))

    def work(batches):
        known = Model(*shared.value)
        for (column,) in batches:
            yield [pa.array([main_text(known, x.as_py()) for x in column], pa.string())]

    return with_columns_by_arrow(pages, [html], "text string", work)

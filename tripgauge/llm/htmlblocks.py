"""DOM leaf blocks of a page and their features."""

from __future__ import annotations

import html
import re

#: FIXED VALUES of HTML: elements whose edges part blocks, elements without an end, elements whose text isn't shown.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
SECTION = frozenset("article aside dialog fieldset footer form header main menu nav section".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template textarea iframe svg math object canvas audio video".split())
#: What an opening element closes if it is still open, and how far up that reaches.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head", "title"}, {"html"})}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """An open element: tag, name parts, the element it is in, and what its blocks' features share. Blocks of one element share the node,
    and an element that adds no tag or name of its own shares its parent's sets, so deep pages cost no more than their elements."""

    __slots__ = ("tag", "names", "parent", "depth", "parts", "near", "shared")

    def __init__(self, tag, names, parent, known):
        self.tag, self.names, self.parent, self.shared = tag, names, parent, None
        self.depth = parent.depth + 1 if parent else 1
        own = {f"under {tag}", *(f"name {p}" for p in names)}
        if known is not None:
            own &= known
        above = parent.parts if parent else frozenset()
        self.parts = above if own <= above else above | own
        # The nearest element with names, or that is a section.
        self.near = self if names or tag in SECTION else parent.near if parent else None


class Block:
    """A run of text between block edges: the element it is in (None: none), text, and characters in links."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, node, text, linked):
        self.node, self.text, self.linked = node, text, linked


def blocks(page: str, known=None) -> list[Block]:
    """The leaf blocks with text, in page order. Character references are decoded; white space becomes one space.
    Features of ancestors outside ``known`` (a set of names, default: all) are left out, as a model has no weights for them."""
    stack: list[Node] = []
    places: dict[str, list[int]] = {}  # where in the stack each tag is open, so that no search walks the stack
    out: list[Block] = []
    run: list[str] = []
    linked = link = 0

    def flush():
        nonlocal linked, link
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                out.append(Block(stack[-1] if stack else None, text, linked))
            run.clear()
        linked = link = 0

    def close(size):
        while len(stack) > size:
            places[stack.pop().tag].pop()

    def innermost(tags):
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            run.append(page[at:stop])
            linked += (stop - at) * (link > 0)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                link = 0
            elif tag in BLOCK:
                flush()
                if places.get(tag):
                    close(places[tag][-1])
            continue
        if tag in HIDDEN:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "a":
            link = 1
        elif tag in ("br", "img", "wbr"):
            run.append(" ")
        elif tag in BLOCK:
            flush()
            if stack and stack[-1].tag == "p":
                close(len(stack) - 1)
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                if (at_end := innermost(ends)) > innermost(bounds):
                    close(at_end)
            if tag not in VOID:
                names = tuple(p.lower() for a in _NAMES.findall(m[3]) for p in _PARTS.findall(a[1] or a[2] or a[3])) if m[3] else ()
                places.setdefault(tag, []).append(len(stack))
                stack.append(Node(tag, names, stack[-1] if stack else None, known))
    flush()
    return out


def _shared(node: Node | None) -> list[str]:
    """What the features of an element's blocks have in common; made once an element."""
    if node is None:
        return ["bias", "in -", "depth 0"]
    if node.shared is None:
        parts, near = node.parts, node.near
        if near:
            parts = parts | {f"near {p}" for p in near.names} | ({f"near <{near.tag}>"} if near.tag in SECTION else set())
        node.shared = ["bias", *sorted(parts), f"in {node.tag}", f"depth {min(node.depth, 8)}"]
    return node.shared


def features(found: list[Block]) -> list[list[str]]:
    """For each block: its ancestors' tags and name parts, and its text's size, links, punctuation and first and last characters."""
    out = []
    for b in found:
        shared = _shared(b.node)
        text = b.text
        words = text.count(" ") + 1
        share = b.linked / max(1, len(text))
        stops = text.count(".") + text.count("!") + text.count("?") + text.count("。")
        size = "1" if words < 3 else "2" if words < 8 else "3" if words < 20 else "4" if words < 60 else "5"
        links = "none" if share == 0 else "some" if share < 0.4 else "most"
        out.append([*shared, f"words {size}", f"links {links}", f"words {size} links {links}", f"ends {'stop' if text[-1] in '.!?…。:”\"' else 'open'}",
                    f"sentences {min(stops, 3)}", f"commas {min(text.count(','), 3)}", f"mark {'yes' if '©' in text else 'no'}"])
    return out

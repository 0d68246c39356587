"""Reading a page's HTML: the only row-level Python of the job.

One compiled expression splits a page into text, title, scripts and meta tags inside the regex
engine. Only pages that hold microdata, a seller block or a description frame are then walked tag
by tag. Nothing is interpreted here: prices, offers, images and priorities are decided afterwards
by column expressions.
"""

import html
import json
import re
from urllib.parse import urljoin

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""


def _block(names, attributes, body):
    """An element with everything up to its end tag, or to the end of the page without one."""
    inside = rf"(?:[^<]++|<(?!/(?:{names})[\s/>]))*+"
    return (
        rf"<(?:{names})(?=[\s/>]){attributes.format(_ATTRIBUTES)}>?"
        rf"{body.format(inside)}(?:</(?:{names})[^>]*+>?)?"
    )


_COMMENT = r"<!--(?:[^-]++|-(?!->))*+(?:-->)?|<[!?][^>]*+>?"
_UNSEEN = _block("style|template", "{}", "{}")

# Splitting by this gives, for every tag, the text before it and these five groups.
PARTS = re.compile(
    "|".join(
        (
            _COMMENT,
            _block("title", "{}", "({})"),
            _block("textarea", "{}", "({})"),
            _block("script", "({})", "({})"),
            _UNSEEN,
            rf"<meta(?=[\s/>])({_ATTRIBUTES})>?",
            rf"</?[a-z]{_ATTRIBUTES}>?",
        )
    ),
    re.I,
)
STRIDE = 1 + PARTS.groups

# The same page tag by tag, for the pages that need their structure.
TAGS = re.compile(
    "|".join(
        (
            _COMMENT,
            _block("script", "{}", "{}"),
            _UNSEEN,
            _block("title", "{}", "({})"),
            _block("textarea", "{}", "({})"),
            rf"<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})>?",
        )
    ),
    re.I,
)
ATTRIBUTE = re.compile(
    r"([^\s=>\"'/][^\s=>/]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S
)
CONTROL = re.compile(r"^\s*(?:<!--|<!\[CDATA\[|//\s*<!\[CDATA\[)|(?:-->|//\s*\]\]>|\]\]>)\s*$")

# Fixed values of the HTML standard: elements without an end tag, and elements that a sibling
# of the same name closes.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SIBLING_CLOSES = frozenset("dd dt li option p td th tr".split())

# Fixed values of the microdata standard: the attribute that holds an element's value.
VALUE_ATTRIBUTE = {
    "a": "href",
    "area": "href",
    "audio": "src",
    "data": "value",
    "embed": "src",
    "iframe": "src",
    "img": "src",
    "link": "href",
    "meta": "content",
    "meter": "value",
    "object": "data",
    "source": "src",
    "time": "datetime",
    "track": "src",
    "video": "src",
}
ADDRESS_ATTRIBUTES = frozenset(("href", "src", "data"))
META_FIELDS = ("name", "property", "content", "price", "currency", "category")


def attributes(source):
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def json_objects(block):
    """The JSON objects of a script block, each as clean JSON text; nothing when unreadable."""
    for text in (block, CONTROL.sub("", block)):
        try:
            value = json.loads(text, strict=False, parse_constant=lambda _: None)
        except (ValueError, RecursionError):
            continue
        items = value if isinstance(value, list) else [value]
        return [json.dumps(item) for item in items if isinstance(item, dict)]
    return []


def type_name(itemtype):
    names = [re.split(r"[/#]", name.rstrip("/#"))[-1] for name in itemtype.split()]
    return names[0] if len(names) == 1 else names


def put(item, names, value):
    """Add a property; a repeated property becomes a list."""
    for name in names:
        if name not in item:
            item[name] = value
        elif isinstance(item[name], list):
            item[name].append(value)
        else:
            item[name] = [item[name], value]


class Element:
    """An open element of a tracked page and what has to happen to its text when it closes."""

    __slots__ = ("name", "parts", "finish", "item", "role")

    def __init__(self, name):
        self.name, self.parts, self.finish, self.item, self.role = name, None, None, None, None


class TrackedPage:
    """Nested microdata items, the seller block and the description frame of one page."""

    def __init__(self, base_url, names, source):
        self.base_url, self.names = base_url, names
        self.has_seller_block = names["seller"] in source or "ux-labels-values" in source
        self.open, self.capturing, self.items = [], [], []
        self.seller = self.seller_info = self.seller_url = self.location = None
        self.frame_src = None
        self.seen = set()

    def walk(self, source):
        at = 0
        for tag in TAGS.finditer(source):
            title, textarea, close, name, raw = tag.groups()
            if self.capturing:
                self.text(unescaped(source[at : tag.start()]))
                self.text(unescaped(title or textarea or ""))
            at = tag.end()
            if close:
                self.close(name.lower())
            elif name:
                self.start(name.lower(), attributes(raw) if self.matters(raw) else {})
        if self.capturing:
            self.text(unescaped(source[at:]))
        self.close_all()

    def matters(self, raw):
        """Whether a tag's attributes can say anything here."""
        if self.has_seller_block:
            return len(raw) > 1
        return "item" in raw.lower() or self.names["frame"] in raw

    def role_open(self, role):
        return any(e.role == role for e in self.open)

    def text(self, data):
        for element in self.capturing:
            element.parts.append(data)

    def close(self, name):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name == name:
                for element in reversed(self.open[at:]):
                    if element.finish:
                        self.capturing.remove(element)
                        element.finish(element.parts)
                del self.open[at:]
                return

    def close_all(self):
        if self.open:
            self.close(self.open[0].name)

    def start(self, name, attrs):
        if self.open and name in SIBLING_CLOSES and self.open[-1].name == name:
            self.close(name)
        element = Element(name)
        if attrs:
            self.microdata(element, attrs)
            if "frame" not in self.seen and attrs.get("id") == self.names["frame"]:
                self.seen.add("frame")
                self.frame_src = attrs.get("src")
        if self.has_seller_block:
            self.seller_block(element, attrs)
        if name not in VOID:
            self.open.append(element)

    def microdata(self, element, attrs):
        parent = next((e.item for e in reversed(self.open) if e.item is not None), None)
        props = attrs.get("itemprop", "").split()
        if "itemscope" in attrs:
            element.item = {}
            if attrs.get("itemtype"):
                element.item["@type"] = type_name(attrs["itemtype"])
            if props and parent is not None:
                put(parent, props, element.item)
            else:
                self.items.append(element.item)
        elif props and parent is not None:
            source = VALUE_ATTRIBUTE.get(element.name, "content")
            if source in attrs or element.name in VOID:
                value = attrs.get(source, "")
                if source in ADDRESS_ATTRIBUTES:
                    value = self.join(value)
                put(parent, props, value)
            else:
                self.capture(element, lambda p: put(parent, props, " ".join("".join(p).split())))

    def join(self, address):
        try:
            return urljoin(self.base_url, address)
        except ValueError:
            return address

    def capture(self, element, use):
        """Collect the element's text; several uses of one element share it."""
        earlier = element.finish
        if earlier is None:
            element.parts = []
            self.capturing.append(element)

        def finish(parts):
            if earlier:
                earlier(parts)
            use(parts)

        element.finish = finish

    def seller_block(self, element, attrs):
        classes = attrs.get("class", "").split()
        class_text = " ".join(classes)
        if element.name == "div":
            if "seller" not in self.seen and self.names["seller"] in classes:
                self.seen.add("seller")
                element.role, self.seller_info = "seller", []
            if "location" not in self.seen and class_text == self.names["location"]:
                self.seen.add("location")
                self.capture(element, lambda p: self.keep_location("".join(p)))
        if element.role == "seller" or self.role_open("seller"):
            if not self.seller_url and attrs.get("href"):
                # The address as it stands in serialised markup, where & < > are escaped.
                self.seller_url = html.escape(attrs["href"], quote=False)
            if element.name == "a" and "link" not in self.seen:
                self.seen.add("link")
                element.role = "link"
            elif element.name == "span":
                if class_text == self.names["span"]:
                    self.capture(element, lambda p: self.seller_info.append("".join(p)))
                if self.role_open("link") and "name" not in self.seen:
                    self.seen.add("name")
                    self.capture(element, self.keep_seller)

    def keep_seller(self, parts):
        self.seller = "".join(p.strip() for p in parts)

    def keep_location(self, text):
        self.location = text.split(":")[-1].strip()


def unescaped(text):
    return html.unescape(text) if "&" in text else text


def visible(parts):
    """The text nodes of a split page in document order."""
    return [
        unescaped(piece)
        for at in range(0, len(parts), STRIDE)
        for piece in parts[at : at + 3]
        if piece
    ]


def scan(source, base_url, names):
    """Everything the extractors need from one page, as a dict with the fields of PARSED."""
    parts = PARTS.split(source)
    titles = [t for t in parts[1::STRIDE] if t is not None]
    jsonld = []
    for attrs, body in zip(parts[3::STRIDE], parts[4::STRIDE]):
        if attrs and attributes(attrs).get("type", "").strip().lower() == "application/ld+json":
            jsonld.extend(json_objects(body))
    metas = []
    for attrs in parts[5::STRIDE]:
        if attrs is not None:
            found = attributes(attrs)
            metas.append({f: found.get(f) for f in META_FIELDS})
    page = TrackedPage(base_url or "", names, source)
    if page.has_seller_block or "itemscope" in source or names["frame"] in source:
        page.walk(source)
    return {
        "title": unescaped(titles[0]) or None if titles else None,
        "text": "".join(visible(parts)),
        "jsonld": jsonld,
        "microdata": [json.dumps(item) for item in page.items],
        "metas": metas,
        "seller": page.seller,
        "seller_info": page.seller_info,
        "seller_url": page.seller_url,
        "location": page.location,
        "frame_src": page.frame_src,
    }


def separated_text(source):
    """Visible text with the stripped text nodes on lines of their own."""
    lines = (piece.strip() for piece in visible(PARTS.split(source)))
    return "\n".join(line for line in lines if line)

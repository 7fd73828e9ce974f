"""Parsers of landed HTML pages and nested payloads that SQL expressions cannot take apart, as table functions over Arrow batches.

Each parser is a plain function from a page to dicts; `parse_table` runs one over a table of pages. Pages are parsed one at a time.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

from rosterweave.operators.limits import record_limit
from rosterweave.shipping import ship

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style template noscript".split())
EMAIL = re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}")
PHONE = re.compile(r"(?:\+\d{1,3}|0)[0-9\s\-()]{6,18}\d")


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, *tags: str, **attrs: str) -> Iterator[Node]:
        """Nodes below with one of the tags whose attributes match the patterns."""
        for node in self.walk():
            if node is not self and (not tags or node.tag in tags) and all(re.search(p, node.attrs.get(k.rstrip("_"), "")) for k, p in attrs.items()):
                yield node

    def find(self, *tags: str, **attrs: str) -> Node | None:
        return next(self.find_all(*tags, **attrs), None)

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in _SKIPPED:
                stack.extend(reversed(node.children))
        return " ".join(" ".join(out).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(page: str | None) -> Node:
    parser = _Tree()
    parser.feed(page or "")
    parser.close()
    return parser.root


def label_map(root: Node) -> dict[str, str]:
    """PA6, PA7: label and value of tables (th/td) and lists (dt/dd); the first of each label."""
    out: dict[str, str] = {}
    for row in root.find_all("tr"):
        head, value = row.find("th"), row.find("td")
        if head and value:
            out.setdefault(head.text(), value.text())
        elif not head and len(cells := list(row.find_all("td"))) >= 2:
            out.setdefault(cells[0].text().rstrip(":："), cells[1].text())
    for dl in root.find_all("dl"):
        term = ""
        for node in dl.find_all("dt", "dd"):
            if node.tag == "dt":
                term = node.text()
            elif term:
                out.setdefault(term, node.text())
    return out


def linked_data(root: Node) -> list[dict]:
    """PA6: the objects of a page's linked-data scripts."""
    out = []
    for script in root.find_all("script", type=r"ld\+json"):
        try:
            data = json.loads("".join(c for c in script.children if isinstance(c, str)))
        except ValueError:
            continue
        out += [d for d in (data if isinstance(data, list) else [data]) if isinstance(d, dict)]
    return out


def first_external_link(root: Node, base: str) -> str:
    """PA16: the first link to another host."""
    own = urlsplit(base).netloc.removeprefix("www.")
    for a in root.find_all("a", href="^https?://"):
        host = urlsplit(a.attrs["href"]).netloc.removeprefix("www.")
        if host and host != own and not host.endswith(f".{own}"):
            return a.attrs["href"]
    return ""


def labelled_link(root: Node, labels: tuple[str, ...]) -> str:
    """PA16: the link beside a label, or whose own text is one."""
    for row in root.find_all("tr", "li", "p", "div", "dd"):
        words = row.text().lower()
        if len(words) < 200 and any(words.startswith(x) for x in labels) and (a := row.find("a", href="^https?://")):
            return a.attrs["href"]
    return next((a.attrs["href"] for a in root.find_all("a", href="^https?://") if a.text().lower() in labels), "")


def company_cards(page: str, base: str, href: str, card: tuple[str, ...] = ("li", "article", "tr", "section")) -> list[dict]:
    """PA6: one row for each link that looks like `href`, with the text of its card; each address once."""
    out, seen = [], set()
    for a in tree(page).find_all("a", href=href):
        url = urljoin(base, a.attrs["href"])
        if url in seen or not a.text():
            continue
        seen.add(url)
        node = a.parent
        while node is not None and node.tag not in card:
            node = node.parent
        out.append({"company_name": a.text(), "detail_url": url, "summary": node.text() if node else ""})
    return out


def company_detail(page: str, base: str, labels: dict[str, tuple[str, ...]]) -> list[dict]:
    """PA6, PA7: a company's fields by label lists, the first filled wins; linked data and the first external link fill what is blank."""
    root = tree(page)
    found = label_map(root)
    row = {field: next((found[x] for x in names if found.get(x)), "") for field, names in labels.items()}
    for data in linked_data(root):
        org = data.get("hiringOrganization") if isinstance(data.get("hiringOrganization"), dict) else data
        row["company_name"] = row.get("company_name") or str(org.get("name") or "")
        row["website"] = row.get("website") or str(org.get("sameAs") or org.get("url") or "")
    row["company_name"] = row.get("company_name") or (h.text() if (h := root.find("h1")) else "")
    row["website"] = row.get("website") or first_external_link(root, base)
    return [row]


def job_detail(page: str, base: str) -> list[dict]:
    """PA5: addresses from mailto links first, then from the text; a phone; the name after a contact label."""
    root = tree(page)
    mailto = [a.attrs["href"][7:].split("?")[0] for a in root.find_all("a", href="(?i)^mailto:")]
    words = root.text()
    emails = list(dict.fromkeys(e.lower() for e in [*mailto, *EMAIL.findall(words)] if "@" in e))
    phone = PHONE.search(words)
    who = re.search(r"(?:Yhteyshenkilö|Lisätietoja antaa|Contact person|Lisätiedot)\s*:?\s*([A-ZÅÄÖ][\w\-]+(?:\s+[A-ZÅÄÖ][\w\-]+){1,2})", words)
    return [{"email": emails[0] if emails else "", "emails": ";".join(emails), "phone": phone.group(0).strip() if phone else "", "representative": who.group(1) if who else ""}]


def register_results(page: str, base: str) -> list[dict]:
    """PA8: results of a company register."""
    out = []
    for box in tree(page).find_all(id="^results$"):
        for item in box.find_all("li"):
            if a := item.find("a", href=r"(?i)^/company/[A-Z0-9]+$"):
                number = a.attrs["href"].rsplit("/", 1)[1]
                out.append({"company_name": a.text(), "company_number": number, "company_url": urljoin(base, a.attrs["href"]), "is_active": str("dissolved" not in item.text().lower()).lower()})
    return out


def register_officers(page: str, base: str) -> list[dict]:
    """PA8: officers with role, and whether they are current."""
    out = []
    for box in tree(page).find_all("div", class_="appointments-list"):
        for item in box.children:
            if not isinstance(item, Node) or not item.attrs.get("class", "").startswith("appointment-") or not (name := item.find("h2", class_="heading-medium")):
                continue
            role, tag = item.find("dd", id="^officer-role-"), item.find("span", class_="status-tag")
            status = tag.text().lower() if tag else ""
            out.append({"name": name.text(), "role": role.text() if role else "", "is_active": str(not status or ("active" in status and "resigned" not in status)).lower()})
    return out


def blocks_between_links(page: str, base: str, href: str) -> list[dict]:
    """PA9: for each company link, the first external address between it and the next company link; each company once."""
    links = [m for m in re.finditer(rf"(?is)<a\b[^>]*href=[\"']({href})[\"'][^>]*>(.*?)</a>", page or "")]
    out, seen, own = [], set(), urlsplit(base).netloc
    for at, m in enumerate(links):
        name = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", m.group(m.lastindex))).split())
        block = page[m.end() : links[at + 1].start() if at + 1 < len(links) else len(page)]
        site = next((u for u in re.findall(r"https?://[^\s\"'<>]+", html.unescape(block)) if urlsplit(u).netloc and not urlsplit(u).netloc.endswith(own)), "")
        key = "".join(c.lower() for c in name if c.isalnum())
        if name and site and key not in seen:
            seen.add(key)
            out.append({"company_name": name, "website": site})
    return out


def place_entries(payload: str, base: str = "") -> list[dict]:
    """PA10: arrays of a nested payload that hold a place id (0x..:0x..), with their strings; inner ones too. Depth is not limited."""
    text = payload.strip()
    text = text[4:] if text.startswith(")]}'") else text
    try:
        top = json.loads(text)
    except ValueError:
        return []
    out, stack = [], [top]
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            stack.extend(reversed(node.values()))
        elif isinstance(node, list):
            strings = _strings(node)
            if any("0x" in s and ":0x" in s for s in strings):
                out.append({"strings": json.dumps(strings, ensure_ascii=False)})
            stack.extend(reversed(node))
    return out


def _strings(node) -> list[str]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x.strip():
                out.append(x)
        elif isinstance(x, (list, dict)):
            stack.extend(reversed(list(x.values()) if isinstance(x, dict) else x))
    return out


def pager(page: str, base: str = "", parameter: str = "page", per_page: int = 0, total: str = r"([0-9][0-9,]*)\s*(?:results|件|社)") -> list[dict]:
    """PA14: the number of pages: the largest in the page's links, or from the count of results."""
    largest = max((int(n) for n in re.findall(rf"[?&;/]{parameter}[=/](\d+)", page or "")), default=1)
    count = int(m.group(1).replace(",", "")) if (m := re.search(total, page or "")) else 0
    return [{"total_pages": str(max(largest, -(-count // per_page) if per_page else 1)), "total_results": str(count)}]


def codes(page: str, base: str = "", parameter: str = "code") -> list[dict]:
    """PA14: distinct codes in the page's links, in order."""
    return [{"code": c} for c in dict.fromkeys(re.findall(rf"[?&;]{parameter}=([^\"'&#]+)", page or ""))]


def to_markdown(page: str, base: str = "", most: int = 80_000) -> str:
    """UR11: headings, links, list items and paragraphs of a page as Markdown; head and tail of what is longer than `most`."""
    out: list[str] = []
    left: list[Node | str] = list(reversed(tree(page).children))
    while left:  # a stack, so that pages may be nested as deep as they like
        c = left.pop()
        if isinstance(c, str):
            out.append(re.sub(r"\s+", " ", c))
        elif c.tag in _SKIPPED or c.tag in ("head", "svg", "iframe"):
            continue
        elif re.fullmatch("h[1-6]", c.tag):
            out.append(f"\n\n{'#' * int(c.tag[1])} {c.text()}\n\n")
        elif c.tag == "a" and c.attrs.get("href"):
            out.append(f"[{c.text()}]({c.attrs['href']})")
        elif c.tag == "br":
            out.append("\n")
        else:
            out.append("\n- " if c.tag == "li" else "\n\n" if c.tag in ("p", "div", "ul", "ol", "table", "tr", "section", "article") else "")
            left.extend(reversed(c.children))
    text = "".join(out)
    text = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", text)).strip()
    return text if len(text) <= most else text[: most // 2] + "\n\n...\n\n" + text[-(most // 2) :]


def parse_table(df: DataFrame, parser: Callable[[str, str], list[dict]], fields: list[str], page: str = "html", url: str = "url", keys: tuple[str, ...] = ("page_id",), errors: bool = False, seconds: float | None = None, fatal: tuple[type[BaseException], ...] = (MemoryError,)) -> DataFrame:
    """Rows of a parser over a table of pages: the keys, pos, and the fields as strings.

    QS12: with errors, a page that a parser fails on, or spends over `seconds` on, gives one row with the error's text instead of ending the job. Errors of the `fatal` classes end it always."""
    ship(df.sparkSession)
    fields = [*fields, "error"] if errors else fields
    types = dict(df.dtypes)
    table = df.select(*keys, url, page)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "pos int", *(f"{f} string" for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, made = [], []
            for i in range(batch.num_rows):
                try:
                    with record_limit(seconds):
                        rows = parser(batch.column(len(keys) + 1)[i].as_py() or "", batch.column(len(keys))[i].as_py() or "")
                except Exception as e:
                    if not errors or isinstance(e, fatal):
                        raise
                    rows = [{"error": f"{type(e).__name__}: {e}"[:500]}]
                for pos, row in enumerate(rows):
                    at.append(i)
                    made.append((pos, *(str(row.get(f, "") or "") for f in fields)))
            take = pa.array(at, pa.int64())
            columns = list(zip(*made, strict=True)) or [[] for _ in range(len(fields) + 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(len(keys))), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.string()) for c in columns[1:])], names=[*keys, "pos", *fields])

    return table.mapInArrow(run, schema)

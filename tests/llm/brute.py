"""Plain versions of the operators, row by row."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Columns that clash with names the operators use inside.
CLASHING = ["row", "digest", "bucket", "_id", "_kept", "c0", "class", "score", "n_lines", "part", "key", "component"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def exact(rows):
    """(doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for place, (doc, text) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        sha = hashlib.sha256(plain.encode()).hexdigest()
        groups[sha].append((-len(text or ""), doc is None, doc or 0, place, doc))
    out = []
    for sha, members in groups.items():
        best = min(members)
        out += [(m[4], best[4], len(members), m is best, sha) for m in members]
    return out


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def linked(rows, size=5, percent=75):
    """doc_id -> (set size, smallest id of its component)."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    where = defaultdict(list)
    for doc, grams in sets.items():
        for gram in grams:
            where[gram].append(doc)
    shared = defaultdict(int)
    for docs in where.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                shared[(b, a)] += 1
    parent = {doc: doc for doc in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (len(grams), find(doc)) for doc, grams in sets.items()}


def line_dedup(rows, least=5):
    """doc_id -> (text, lines with a word, removed)."""
    first, places = {}, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        for i, line in enumerate((text or "").split("\n")):
            w = tuple(words(line))
            if w:
                places.append((doc, i, w))
                first.setdefault(w, (doc, i))
    variants = defaultdict(list)
    for w, place in first.items():
        if len(w) >= least:
            variants[w].append((place, -1))
            for i in range(len(w)):
                variants[w[:i] + w[i + 1 :]].append((place, i))
    late = {p for group in variants.values() for p, i in group for q, j in group if q < p and (i == j or -1 in (i, j))}
    keep = {(doc, i) for doc, i, w in places if first[w] == (doc, i) and (doc, i) not in late}
    worded = defaultdict(list)
    for doc, i, _ in places:
        worded[doc].append(i)
    out = {}
    for doc, text in rows:
        drop = {i for i in worded[doc] if (doc, i) not in keep}
        rest = [line for i, line in enumerate((text or "").split("\n")) if i not in drop]
        out[doc] = ("\n".join(rest) if drop else text, len(worded[doc]), len(drop))
    return out


def within_one(a, b):
    """Word edit distance of at most 1."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def tiles(test, doc, least):
    free_t, free_d, out = [True] * len(test), [True] * len(doc), []
    while True:
        best, found = least - 1, []
        for i in range(len(test)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(test) and j + k < len(doc) and test[i + k] == doc[j + k] and free_t[i + k] and free_d[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if best < least:
            return out
        for i, j in found:
            if all(free_t[i : i + best]) and all(free_d[j : j + best]):
                free_t[i : i + best] = [False] * best
                free_d[j : j + best] = [False] * best
                out.append((i, j, best))


def overlaps(rows, items, least=5, percent=75):
    out = []
    for doc, text in rows:
        w = words(text)
        grams = {tuple(w[i : i + least]) for i in range(len(w) - least + 1)}
        for item, other in items:
            t = words(other)
            if any(tuple(t[i : i + least]) in grams for i in range(len(t) - least + 1)):
                found = tiles(t, w, least)
                covered = sum(x[2] for x in found)
                if 100 * covered >= percent * len(t):
                    out.append((doc, item, len(found), covered, len(t)))
    return out


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def secret(text):
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = []
    for m in re.finditer(rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 8:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def pieces_of(word, vocabulary):
    """Greedy longest match of the marked word; 0 where it fails."""
    s, i, n = "▁" + word, 0, 0
    longest = max(map(len, vocabulary), default=0)
    while i < len(s):
        j = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in vocabulary), None)
        if j is None:
            return 0
        n, i = n + 1, j
    return n


def spelling(rows, least_count=5, times=5):
    """Sorted (word, form, root, n, n_near, form_n), with the near words found by trying every edit."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                n[word] += 1
    n = {w: k for w, k in n.items() if k >= least_count}
    letters = sorted(set("".join(n)))
    near, form = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        near[w] = [e for e in edits - {w} if e in n]
        best = min(near[w], key=lambda e: (-n[e], e), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def middle(doc, text, percent=50):
    """(doc_id, n, form, prefix_chars, middle_chars, output) of one row."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    return doc, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def frame(spark, rows, extra=()):
    """A documents table with clashing extra columns."""
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in [*CLASHING, *extra])
    return spark.createDataFrame([(doc, text, *["x"] * (len(CLASHING) + len(extra))) for doc, text in rows], schema)


def near_copies(random, count=60, vocabulary=400):
    """Documents with copies of growing distance, shared passages, short and empty texts, and nulls."""
    word = lambda: f"w{random.randrange(vocabulary * 20)}"
    passage = " ".join(word() for _ in range(40))
    rows = []
    for doc in range(count):
        kind = random.random()
        if rows and kind < 0.6:
            w = (random.choice(rows)[1] or "a").split(" ")
            for _ in range(random.choice((0, 1, 1, 2, 3, 5))):
                w[random.randrange(len(w))] = word()
            text = " ".join(w)
        elif kind < 0.75:
            text = passage + " " + " ".join(word() for _ in range(random.randint(0, 30)))
        elif kind < 0.8:
            text = " ".join(word() for _ in range(random.randint(0, 4)))
        elif kind < 0.83:
            text = None
        else:
            text = "\n".join(" ".join(word() for _ in range(random.randint(1, 30))) for _ in range(random.randint(1, 4)))
        rows.append((doc, text))
    return rows


class Blocks(HTMLParser):
    """Texts between block tags, by the parser of the standard library; for pages whose hidden elements are closed."""

    HIDDEN = {"script", "style", "template", "svg", "iframe", "noscript", "object", "canvas", "select", "textarea", "title", "annotation"}
    BLOCKS = {"html", "head", "body", "article", "section", "div", "p", "h1", "ul", "li", "table", "tr", "td", "nav", "hr", "blockquote", "pre"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.texts, self.parts, self.depth = [], [], 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.texts.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.HIDDEN
        if tag == "br":
            self.parts.append(" ")
        if tag in self.BLOCKS and not self.depth:
            self.flush()

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        if tag in self.BLOCKS and not self.depth:
            self.flush()

    def handle_endtag(self, tag):
        if tag in self.BLOCKS and not self.depth:
            self.flush()
        self.depth -= tag in self.HIDDEN

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)

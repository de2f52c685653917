"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import re

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    text = text or ""
    for kind, rx in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in rx.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def base_digest(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)).encode()).hexdigest()


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(docs, items, window=13):
    """{doc id: (n_words, n_hit, sorted items, number of items)}; items without an id are told apart by their words"""
    found = {}
    for doc, text in docs:
        words = words_of(text)
        hit, ids, nameless = set(), set(), set()
        for item, body in items:
            w = words_of(body)
            k = min(window, len(w))
            for s in range(len(w) - k + 1) if w else ():
                for at in range(len(words) - k + 1):
                    if words[at : at + k] == w[s : s + k]:
                        hit.update(range(at, at + k))
                        (ids.add(str(item)) if item is not None else nameless.add(tuple(w)))
        found[doc] = (len(words), len(hit), sorted(ids), len(ids) + len(nameless))
    return found


def shingles(text, k=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(docs, percent=75):
    """{doc id: (set size, smallest linked id)} by all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}

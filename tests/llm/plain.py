"""The operators' results in plain Python, the slow and obvious way."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import regex
import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, size=10):
    """n_words, n_hit, n_items, items_sha256, contaminated for each text."""
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        length = min(size, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            windows[tuple(words[i:i + length])].add("" if item is None else str(item))
    out = []
    for text in docs:
        words, hit, found = item_words(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(words) - length + 1):
                names = windows.get(tuple(words[i:i + length]))
                if names:
                    hit.update(range(i, i + length))
                    found |= names
        out.append((len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text):
    words = BLANK_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def groups(prints, bits=2):
    """Index of a representative of each print's group, by comparing all with all."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def statistics(text):
    text = text or ""
    words = BLANK_WORDS.findall(text)
    lines = [line for line in text.split("\n") if BLANK_WORDS.search(line)]
    windows, covered = Counter(zip(*(words[i:] for i in range(5)))), set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def private(text):
    """(start, kind's place, end, kind) of the fixed patterns, in order."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def context(text, start):
    """The words that a string's pattern is made of; None for a list that began farther back."""
    first = max(0, start - 160)
    window = text[first:start].lower()
    parted = regex.search(r"[ \t-\r]", window)
    words = regex.sub(r"^[^ \t-\r]+", "", window) if first and parted else window
    words = regex.sub(r"[^ \t-\r]*[0-9@][^ \t-\r]*", "\x01", words)
    words = regex.split(r"[ \t-\r]+", regex.sub(r"[\x01 \t-\r\p{P}\p{S}]+\Z", "", words).strip(" "))
    words = [w for w in words if w]
    if len(words) > 1:
        return " ".join(words[-2:])
    if not first:
        return f"^ {words[0]}" if words else ""
    return words[0][-16:] if words and not parted else None


def limits(edges):
    """What scores rise to, each pattern and instance worked out again as long as anything rises."""
    score = {edge: float(seed) for edge, seed in edges.items()}
    by, of = defaultdict(list), defaultdict(list)
    for words, value in edges:
        by[words].append(value)
        of[value].append(words)
    while True:
        trust = {}
        for words, values in by.items():
            unseen = sum(not edges[words, v] for v in values)
            known = sum(score[words, v] for v in values)
            trust[words] = known / (len(values) + 0.5 + 0.125 * unseen) if len(values) >= 4 else 0.0
        rise = 0.0
        for (words, value), seed in edges.items():
            if not seed:
                doubt = math.prod(1 - trust[w] for w in of[value] if not edges[w, value])
                rise = max(rise, 1 - doubt - score[words, value])
                score[words, value] = 1 - doubt
        if rise < 1e-9:
            return score


def identifiers(texts, sure=0.8):
    """Spans that bootstrapping adds, for each text."""
    pattern, edges, places = r"(?<![A-Za-z0-9])[A-Za-z]{0,12}+[0-9][A-Za-z0-9./-]{4,}+", {}, []
    for text in texts:
        text, own, given = text or "", [], ""
        base = [(a, b, kind) for a, _, b, kind in private(text)]
        strings = [(a, 0, b, kind) for a, b, kind in base] + [(*m.span()[:1], 1, m.end(), "other") for m in regex.finditer(pattern, text)]
        for a, rank, b, kind in sorted(strings):
            words = context(text, a)
            given = words = given if words is None else words
            if rank and any(a < y and x < b for x, y, _ in base):
                continue
            if words:
                edges[words, text[a:b]] = edges.get((words, text[a:b]), False) or not rank
            if rank:
                own.append((a, b, text[a:b]))
        places.append(own)
    score = limits(edges)
    known = {value for (words, value), s in score.items() if not edges[words, value] and s >= sure - 1e-6}
    return [[(a, 4, b, "identifier") for a, b, value in own if value in known] for own in places]


def masked(text, spans):
    out, end = "", 0
    for a, _, b, kind in sorted(spans):
        if a >= end:
            out += text[end:a] + f"<{kind.upper()}>"
        end = max(end, b)
    return out + text[end:]

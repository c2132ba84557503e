"""Plain Python versions of the contracts, one document at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def blank_words(text: str | None) -> list[str]:
    return [w for w in BLANK.split(text or "") if w]


def line_dedup(texts: dict[int, str | None]) -> dict[int, tuple[int, int, str]]:
    held = defaultdict(set)
    key = lambda line: line.strip("\x20\t\n\x0b\x0c\r").translate(AZ)
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    out = {}
    for d, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or d == max(held[key(x)])]
        out[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def contaminated(texts: dict, items: dict) -> dict[int, tuple]:
    windows = defaultdict(set)
    for i, t in items.items():
        w = item_words(t)
        for s in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[s : s + 10])].add(str(i))
    out = {}
    for d, t in texts.items():
        w = item_words(t)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    ids |= own
        out[d] = (len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit))
    return out


def shingles(text: str | None) -> set[tuple]:
    w = blank_words((text or "").translate(AZ))
    return {tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))} if w else set()


def classes(texts: dict) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def statistics(text: str | None) -> tuple:
    text = text or ""
    w = blank_words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[s : s + 3]) for s in range(len(w) - 2))
    hit = {s + k for s in range(len(w) - 2) if windows[tuple(w[s : s + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def spans(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 16 <= len(d) <= 19 and sum(x if k % 2 == 0 else (2 * x) % 10 + x // 5 for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def base_scores(texts: dict) -> dict[int, tuple]:
    tokens = {d: [*blank_words((t or "").translate(AZ)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    return {
        d: (held[d], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for d, ws in tokens.items()
    }

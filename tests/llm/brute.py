"""Plain Python versions of the contracts, over all pairs where need be."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def components(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats(rows, length):
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - length + 1):
            first.setdefault(tuple(words[d][i : i + length]), d)
    out = {}
    for d, own in words.items():
        keep = [True] * len(own)
        for i in range(len(own) - length + 1):
            if first[tuple(own[i : i + length])] < d:
                keep[i : i + length] = [False] * length
        stay = [w for w, k in zip(own, keep, strict=True) if k]
        out[d] = (len(own), len(own) - len(stay), sha(" ".join(stay)))
    return out


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def conversations(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort()
        said = "".join(t for _, r, t in own if r == "assistant")
        out[conv] = (len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(said), sha(said))
    return out


def _turns(rows, filler):
    """Conversations from (conv_id, turn, role, text) rows, each in order: null turn first, then role, then text."""
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t, filler if r is None else r, filler if x is None else x))
    return {c: sorted(v, key=lambda row: (row[0], row[1] or 0, row[2], row[3])) for c, v in out.items()}


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        out += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    return out


def repairs(ids, rows):
    """Every conversation's report, by trying the cheapest edit lists in order of cost, then of initials."""
    found = _turns(rows, " ")
    out = {}
    for c in ids:
        turns = [(t, r, x) for _, t, r, x in found.get(c, [])]
        ails, seen = [], set()
        for _, r, x in turns:
            bare = x.strip(" \t\n\v\f\r")
            ails.append("blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((r, x))
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, at, roles, text = heapq.heappop(heap)
            if (at, roles[-1:]) in done:
                continue
            done.add((at, roles[-1:]))
            if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
                break
            state = roles[-1:]
            fits = "u" if state != "u" else "a"
            name = {"u": "user", "a": "assistant"}[fits]
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + fits, (*text, f"{name}:")))
            if at < len(turns):
                _, r, x = turns[at]
                heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, text))
                if ails[at] in ("", "truncated"):
                    more = cost + 5 * (ails[at] == "truncated")
                    heapq.heappush(heap, (more + 1, audit + "R", at + 1, roles + fits, (*text, f"{name}:{x}")))
                    if r[:1] == fits or r[:1] == "s" and not roles:
                        heapq.heappush(heap, (more, audit + "K", at + 1, roles + r[:1], (*text, f"{r}:{x}")))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        firsts = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        digest = hashlib.sha256("\n".join(text).encode()).hexdigest()
        out[c] = (gaps, *(ails.count(a) for a in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def trie(rows):
    """(conv_id, depth, parent, members, children, leaves, saved, digest of ended ids) of every node."""
    own = {c: [(r, x) for _, _, r, x in v] for c, v in _turns(rows, "").items() if c is not None}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, members in nodes.items():
        ended = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ended.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def toxic_score(text, model, distance):
    """The score of a text by distances to all entries and windows of eight words on each side."""
    marks, ends = "\"“”„«»", ".,;:!?\"'`“”„«»‘’()[]{}<>*#$%&|~^=+-_/\\…"
    said = "said says say saying wrote writes called calls quote quotes quoted word words term dit dijo sagte".split()
    address = "you your you're youre yours u ur du dich dein ihr tu toi vous usted tú".split()

    def kinds(word):
        whole = [(distance(e.term, word), e.edits) for e in model.entries if not e.stem]
        if any(d == 0 for d, _ in whole):
            return ["whole", 1.0]
        stems = [e for e in model.entries if e.stem]
        if any(word.startswith(e.term) and len(word) > len(e.term) for e in stems):
            return ["stem", 1.0]
        if word in model.innocent:
            return None
        if any(d <= most for d, most in whole):
            return ["whole", 0.5]
        if any(distance(e.term, word[:n]) <= e.edits for e in stems for n in range(1, len(word) - 1)):
            return ["stem", 0.5]
        return None

    def hits(token):
        bare = token.strip(ends)
        own = [kinds(bare)] if bare else []
        if not any(own):
            cut = "".join(" " if c in ends else c for c in bare).split()
            own = [kinds(p) for p in cut]
        return [h for h in own if h]

    tokens = (text or "").lower().split()
    found = [(i, hits(t)) for i, t in enumerate(tokens)]
    found = [(i, h) for i, h in found if h]
    total, quoted = {"whole": 0.0, "stem": 0.0}, 0
    for i, own in found:
        token, left, right = tokens[i], tokens[max(0, i - 8) : i], tokens[i + 1 : i + 9]
        count = lambda part: sum((w[0] in marks) + (len(w) > 1 and w[-1] in marks) for w in part)
        inside = token[0] in marks and token.rstrip(".,;:!?")[-1:] in tuple(marks)
        opened = (count(left) + (token[0] in marks)) % 2 == 1 and count([token, *right]) > 0
        window = [w.strip(ends) for w in left + right]
        quote = inside or opened or any(w in said for w in window)
        weight = (0.25 if quote else 1.0) * (1.5 if any(w in address for w in window) else 1.0)
        before = max((j for j, _ in found if j < i), default=-99)
        after = min((j for j, _ in found if j > i), default=10**9)
        weight *= 1 + 0.1 * ((i - before <= 8) + (after - i <= 8))
        quoted += quote
        for kind, share in own:
            total[kind] += share * weight
    whole, stem = total["whole"], total["stem"]
    features = [math.log1p(whole), math.log1p(stem), stem / math.sqrt(len(tokens)) if tokens else 0.0, math.log1p(quoted)]
    return 1 / (1 + math.exp(-(model.intercept + sum(f * w for f, w in zip(features, model.weights, strict=True)))))

"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, normal=False):
    words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if normal else WORD.findall(text or "")
    if len(words) < 5 and not normal:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_copies(rows, threshold=0.8):
    """For (doc_id, text) rows: links and smallest doc_id of the component, in the rows' order."""
    sets = [shingle_set(t) for _, t in rows]
    holders, links, parent = defaultdict(list), Counter(), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if n >= threshold * (len(own) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
        for s in own:
            holders[s].append(i)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        smallest[root] = min(smallest.get(root, (True, 0)), (doc_id is not None, doc_id or 0)) if root in smallest else (doc_id is not None, doc_id or 0)
    return [(links[i], smallest[find(i)][1] if smallest[find(i)][0] else None) for i in range(len(rows))]


def removed_lines(rows, threshold=0.8, least=1):
    """For distinct (doc_id, text) rows in order: lines with words, and the numbers of those that go."""
    seen, holders, out = [], defaultdict(set), []
    for _, text in rows:
        lines, gone = 0, []
        for i, line in enumerate((text or "").split("\n")):
            own = frozenset(WORD.findall(line))
            lines += bool(own)
            if len(own) < least:
                continue
            shared = Counter(j for w in own for j in holders[w])
            if any(n >= threshold * (len(own) + len(seen[j]) - n) - 1e-9 for j, n in shared.items()):
                gone.append(i)
            if own not in seen:
                for w in own:
                    holders[w].add(len(seen))
                seen.append(own)
        out.append((lines, gone))
    return out


def contained(docs, items, threshold=0.8):
    sets = {d: shingle_set(t, True) for d, t in docs}
    return {(d, i) for i, t in items for own in [shingle_set(t, True)] if own for d, s in sets.items() if len(own & s) >= threshold * len(own) - 1e-9}


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def url_parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match("[^?#]*", rest[len(host) :]).group()


def url_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)

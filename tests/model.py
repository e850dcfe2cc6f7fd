"""Plain Python models of segmentation and alignment, written from their description for comparison."""

import re


def segment(text):
    lines = [(i, s) for i, s in enumerate(text.splitlines()) if s.strip() and not re.fullmatch(r"\s*[.\-_~=·]{4,}\s*", s)]
    starts = []
    for k, (_, s) in enumerate(lines):
        m = re.fullmatch(r"\s{0,8}(\d{1,3})[.),]\s+(\S.*)", s)
        r = re.fullmatch(r"\s{0,8}([IVX]{1,5})[.)]\s+(\S.*)", s)
        n = re.fullmatch(r"\s{0,8}(\d{1,3})\s*[.)]?\s*", s)
        if m:
            starts.append((k, m[1], m[2]))
        elif r and len(r[2].strip()) >= 20:
            starts.append((k, r[1], r[2]))
        elif n and int(n[1]) <= 60 and k + 1 < len(lines):
            after = lines[k + 1][1].strip()
            before = lines[k - 1][1].strip() if k else ""
            if len(after) >= 15 and not re.fullmatch(CHOICE, after) and not re.fullmatch(r"\d{1,3}\s*[.)]?", after) and before.lower() != "module":
                starts.append((k, n[1], None))
    out = []
    for j, (k, label, first) in enumerate(starts):
        to = starts[j + 1][0] if j + 1 < len(starts) else len(lines)
        body = ([first] if first else []) + [s for _, s in lines[k + 1 : to]]
        stem, choices, blank = [], [], False
        for s in body:
            c = re.fullmatch(CHOICE, s)
            if re.match(r"\s*ans\b", s, re.I):
                blank = True
            elif c:
                choices.append([f"{c[1]}) {c[2].strip()}"])
            else:
                (choices[-1] if choices else stem).append(s.strip())
        whole = " ".join(stem)
        kind = "multiple_choice" if choices else "free_response" if blank else "unknown"
        flags = ["lonely_choice"] * (len(choices) == 1) + ["short_stem"] * (len(whole) < 15) + ["roman_numbered"] * label.isalpha()
        flags += ["has_subparts"] * any(re.match(r"\([a-e]\)\s+", s) for s in stem)
        flags += ["inline_choices"] * bool(not choices and re.search(r"\bA[.)]\s+\S.*\bB[.)]\s+\S", whole, re.S))
        if j + 1 == len(starts) and kind == "unknown" and whole and whole[-1] not in ".?!):;\"'":
            flags.append("truncated_at_page_end")
        out.append((j + 1, label, whole, [" ".join(c) for c in choices], kind, lines[k][0], flags))
    return out


# The form of a choice.
CHOICE = r"\s*\(?([A-E])[.)\]]\s+(\S.*)"


def align(labels, canon):
    """Place in canon of each label, or None: searches go through the places of a label, kept by label."""
    places = {}
    for place, label in enumerate(canon):
        places.setdefault(label, []).append(place)

    def soon(label, start):
        """The first place of the label among the ten from `start`."""
        return next((p for p in places.get(label, ()) if start <= p < start + 10), None)

    def followers(place, coming):
        """How many of the labels that come are found one after the other behind a place."""
        count = 0
        for label in coming:
            found = soon(label, place + 1)
            if found is not None:
                place, count = found, count + 1
        return count

    matched = []
    for i, label in enumerate(labels):
        done = [p for p in matched if p is not None]
        if done:
            matched.append(soon(label, done[-1] + 1))
            continue
        coming = labels[i + 1 : i + 4]
        enough = min(2, len([x for x in coming if x in places]))
        matched.append(next((p for p in places.get(label, ()) if followers(p, coming) >= enough), None))
    return matched

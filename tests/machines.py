"""The layout rules as plain sequential machines over line dicts: test oracles for the window passes."""

import re


def register(rows, split):
    """Rule of every line; rows are dicts with page, x0, size, bold, words [(text, x0)]."""
    heading = person = section = table = None
    header, is_open, content = "", False, False
    out = []
    for i, r in enumerate(rows):
        text = " ".join(w for w, _ in r["words"])
        n = rows[i + 1] if i + 1 < len(rows) else None
        starts = r["page"] >= 1 and r["x0"] <= 110 and n and n["bold"] and n["size"] >= 10.5 and n["x0"] <= 110
        if starts and ((r["size"] >= 13 and len(r["words"]) <= 2) or (r["bold"] and r["size"] >= 10.5 and len(r["words"]) == 1 and not re.search("[,(]", text))):
            heading, person, section, is_open = text, None, None, False
            out.append("R1")
        elif heading is None:
            out.append("R2 cover" if r["page"] == 0 else "R2 preamble")
        elif r["size"] <= 10.4 and person:
            if r["bold"]:
                table = True
                out.append("R3 head")
            else:
                out.append("R3 row" if table else "remainder")
        elif r["bold"] and r["x0"] <= 110 and r["size"] >= 10.5:
            if is_open and ")" not in header:
                header += " " + text
                out.append("R4 more")
            else:
                person, header, section, table, is_open = True, text, None, None, True
                out.append("R4 new")
            is_open = is_open and ")" not in header
        else:
            is_open = False
            left = [w for w, x in r["words"] if x < split]
            right = [w for w, x in r["words"] if x >= split]
            if not person:
                out.append("remainder")
            elif left and (left[0].startswith("§") or re.fullmatch(r"\d{1,2}\.", left[0])):
                section, content = True, bool(right)
                out.append("R7")
            elif left and section and not content and not right:
                out.append("R8")
            elif not section:
                out.append("R9")
            else:
                content = True
                out.append("R10" if right and not left else "R11")
    return out


def form(rows, split):
    person = field = affiliation = None
    before = None
    out = []
    for r in rows:
        gap = None if before is None or before[0] != r["page"] else r["top"] - (before[1] or r["top"])
        before = (r["page"], r["top"])
        left = [w for w in r["words"] if w[1] < split]
        right = [w for w in r["words"] if w[1] >= split]
        text = " ".join(w[0] for w in r["words"])
        if all(w[2] for w in r["words"]) and r["words"][0][3] >= 14:
            person, field, affiliation = True, None, None
            out.append("S1")
            continue
        if not person:
            out.append("remainder")
            continue
        if not affiliation and not field and left and not right and not any(w[2] for w in left) and text.startswith("("):
            affiliation = True
            out.append("S3")
            continue
        bold = bool(left) and all(w[2] for w in left)
        if bold and (gap is None or gap > 20 or not field):
            field = True
            out.append("S4 header" if right and all(w[2] for w in right) else "S4")
        elif not field or (left and not bold):
            out.append("remainder")
        else:
            out.append("S5")
    return out

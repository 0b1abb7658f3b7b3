"""Plain-Python statements of the line rules, used as the reference in tests."""


def split(s: str, sep: str) -> list[str]:
    out, cur, prev = [], "", None
    for ch in s:
        if ch == sep and prev != "\\":
            out.append(cur)
            cur = ""
        else:
            cur += ch
        prev = ch
    out.append(cur)
    return out


def null_token(v):
    return None if v in ("", "\\N") else v


def unescape(v):
    if v is None:
        return None
    return v.replace("\\", "") if v.find("\\") > 0 else v


def java_hash(s: str) -> int:
    h = 0
    b = s.encode("utf-16-be", "surrogatepass")
    for i in range(0, len(b), 2):
        h = (h * 31 + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def shard(s: str, n: int) -> int:
    h = java_hash(s)
    r = abs(h) % n
    return r  # |h % n| with the sign of h, then abs, is |h| % n


# Word-boundary classes, stated apart from the operator's.
JOIN_LETTERS = set(":\u00b7\u0387\u05f4\u2027\ufe13\ufe55\uff1a" ".\u2018\u2019\u2024\ufe52\uff07\uff0e" "'")
JOIN_DIGITS = set(",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b" ".\u2018\u2019\u2024\ufe52\uff07\uff0e" "'")
UNDERSCORES = set("_\u203f\u2040\u2054\ufe33\ufe34\ufe4d\ufe4e\ufe4f\uff3f")
KATAKANA_MARKS = set("\u3031\u3032\u3033\u3034\u3035\u309b\u309c\u30a0\u30fc\uff70\uff9e\uff9f")


def _kind(c: str) -> str:
    """letter, hebrew, digit, number, kata, under, ideograph, or the character itself."""
    import unicodedata as u
    name = u.name(c, "") if c else ""
    if name.startswith(("CJK UNIFIED IDEOGRAPH", "HIRAGANA LETTER")):
        return "ideograph"
    if c in KATAKANA_MARKS or name.startswith(("KATAKANA LETTER", "HALFWIDTH KATAKANA LETTER")):
        return "kata"
    if c and c in UNDERSCORES:
        return "under"
    cat = u.category(c) if c else ""
    if cat[:1] == "L":
        return "hebrew" if name.startswith("HEBREW") else "letter"
    return {"Nd": "digit", "Nl": "number", "No": "number"}.get(cat, c)


def words(s: str) -> list[str]:
    """Analysed tokens by the word-boundary rules, decided pair by pair: marks and
    format characters go with the character before them; then, whether there is
    a boundary between two characters follows from them and their neighbours."""
    import unicodedata as u
    units: list[list[str]] = []
    for c in s:
        if (u.category(c)[0] == "M" or u.category(c) == "Cf") and c != "\u200b":
            if units:
                units[-1][1] += c
            else:
                units.append(["", c])
        else:
            units.append([c, c])
    kinds = ["", *[_kind(c) for c, _ in units], "", ""]
    base = ["", *[c for c, _ in units], "", ""]
    letters, alnum = {"letter", "hebrew"}, {"letter", "hebrew", "digit", "number"}

    def joined(k: int) -> bool:            # between character k and the next one
        before, a, b, after = kinds[k - 1] if k else "", kinds[k], kinds[k + 1], kinds[k + 2]
        x, y = base[k], base[k + 1]
        return any((
            a in alnum and b in alnum,
            a == b == "kata",
            b == "under" and a in alnum | {"kata", "under"},
            a == "under" and b in alnum | {"kata"},
            a in letters and y in JOIN_LETTERS and after in letters,
            before in letters and x in JOIN_LETTERS and b in letters,
            a == "digit" and y in JOIN_DIGITS and after == "digit",
            before == "digit" and x in JOIN_DIGITS and b == "digit",
            a == "hebrew" and y == "'",
            a == "hebrew" and y == '"' and after == "hebrew",
            before == "hebrew" and x == '"' and b == "hebrew",
        ))

    out, start = [], 1
    for k in range(1, len(units) + 1):
        if k == len(units) or not joined(k):
            if {*kinds[start:k + 1]} & (alnum | {"kata", "ideograph"}):
                out.append("".join(t for _, t in units[start - 1:k]))
            start = k + 1
    return out

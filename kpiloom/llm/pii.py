"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds anchors: at-signs, digits, plus
signs, URL schemes and identifier cues.  From each anchor a deterministic local
parser walks left and right to the boundaries of what it belongs to and
validates it; no pattern is tried at any other place.

Kinds found by fixed rules ("base"): email, ip (four parts up to 255), card
(13 to 19 digits, Luhn), phone (+ and 9 to 15 digits).  The parsers add: iban
(after a country cue's check digits, mod 97), account (a long number or code
after a cue such as "account" or "iban"), key (access keys with a fixed
prefix), url (a scheme's address with user information, a query or an ip host)
and mail (an address spelled with "(at)" or "[at]").  Spans of a kind never
overlap; those of different kinds may.  Positions count code points, ends are
exclusive.  Null texts are empty and have no spans.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import text_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("mail", "url", "iban", "account", "key")
DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = LETTERS | DIGITS
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
KEY_CHARS = ALNUM | {"_"}
PHONE = DIGITS | frozenset(" ().-")
URL_END = frozenset(" \t\n\r\f\v\"'<>`{}|\\^")
# Cues that announce an account or document number, and prefixes of access keys with their length.
CUES = ("account", "acct", "iban", "konto", "compte", "cuenta", "passport", "ssn", "tax id", "routing", "swift", "customer id", "member id")
KEYS = {"AKIA": 20, "ASIA": 20, "ghp_": 40, "sk_live_": 32, "AIza": 39}
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
SPELLED = ("(at)", "[at]", " at sign ")


def _lowered(t: str) -> str:
    """t with A-Z in lower case, of equal length."""
    return t.lower() if t.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), t)


@functools.lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """For lower-cased texts: cues and schemes count in any spelling, keys and spelled at-signs only in their own."""
    a = ahocorasick.Automaton()
    for w in ("@", "+", *DIGITS):
        a.add_word(w, ("digit" if w in DIGITS else w, 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES), ("key", KEYS), ("spelled", SPELLED)):
        for w in words:
            a.add_word(w.lower(), (kind, len(w)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _run(t: str, i: int, chars: frozenset) -> int:
    """End of the run of chars from i on."""
    n = len(t)
    while i < n and t[i] in chars:
        i += 1
    return i


def _email(t: str, at: int, floor: int) -> tuple[int, int] | None:
    s = at
    while s > floor and t[s - 1] in LOCAL:
        s -= 1
    e = _run(t, at + 1, LABEL)
    if s == at or e == at + 1:
        return None
    end = e
    while end < len(t) and t[end] == "." and (e := _run(t, end + 1, LABEL)) > end + 1:
        end = e
    return (s, end) if "." in t[at:end] else None


def _ip(t: str, s: int) -> tuple[int, bool] | None:
    """End of four dotted numbers from s on, and whether each is at most 255."""
    e, ok = s, True
    for part in range(4):
        if part:
            if e >= len(t) or t[e] != ".":
                return None
            e += 1
        f = _run(t, e, DIGITS)
        if f == e:
            return None
        number = t[e:f].lstrip("0")
        ok = ok and len(number) <= 3 and int(number or 0) <= 255
        e = f
    return e, ok


def _card(t: str, s: int) -> int:
    """End of the digits from s on, single blanks or hyphens between them allowed."""
    n, e = len(t), s + 1
    while e < n:
        if t[e] in DIGITS:
            e += 1
        elif t[e] in " -" and e + 1 < n and t[e + 1] in DIGITS:
            e += 2
        else:
            break
    return e


def _phone(t: str, plus: int) -> tuple[int, bool] | None:
    if plus + 1 >= len(t) or t[plus + 1] not in DIGITS:
        return None
    e = _run(t, plus + 2, PHONE)
    while e > plus + 3 and t[e - 1] not in DIGITS:
        e -= 1
    if e <= plus + 3 or t[e - 1] not in DIGITS:
        return None
    return e, 9 <= sum(c in DIGITS for c in t[plus:e]) <= 15


def _iban(t: str, s: int) -> int | None:
    """End of a valid IBAN from s on; blanks between its groups are allowed."""
    code, ends, i = "", [], s
    while i < len(t) and len(code) < 34:
        if t[i] in ALNUM:
            code += t[i]
            ends.append(i + 1)
            i += 1
        elif t[i] == " " and i + 1 < len(t) and t[i + 1] in ALNUM and code:
            i += 1
        else:
            break
    if not (len(code) >= 15 and code[0].isupper() and code[1].isupper() and code[:2].isalpha() and code[2:4].isdigit()):
        return None
    for n in range(len(code), 14, -1):
        moved = (code[4:n] + code[:4]).upper()
        if (n == len(code) or ends[n - 1] == ends[n] - 2) and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
            return ends[n - 1]
    return None


def _account(t: str, after: int) -> tuple[int, int] | None:
    """The number that a cue announces: within a few words of punctuation, 6 to 34 characters, at least half digits."""
    s = after + (t[after:after + 1] == " ")
    for word in ("", "number", "no", "nr", "num", "id"):
        if word and t[s:s + len(word)].lower() == word:
            s += len(word)
            break
    while s < len(t) and s - after < 16 and t[s] in " \t:=#.,-":
        s += 1
    e = s
    while e < len(t) and e < s + 80 and (t[e] in ALNUM or t[e] in " -" and e > s and e + 1 < len(t) and t[e + 1] in DIGITS):
        e += 1
    body = [c for c in t[s:e] if c in ALNUM]
    digits = sum(c in DIGITS for c in body)
    return (s, e) if 6 <= len(body) <= 34 and 2 * digits >= len(body) else None


def _url(t: str, s: int, after: int) -> tuple[int, bool]:
    e = after
    while e < len(t) and t[e] not in URL_END:
        e += 1
    while e > after and t[e - 1] in ".,;:!?)]":
        e -= 1
    rest = t[after:e]
    host = rest.split("/", 1)[0]
    personal = "@" in host or "?" in rest or t[s:after] == "mailto:" or host.replace(".", "").replace(":", "").isdigit()
    return e, bool(rest and personal)


def spans(t: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), by kind in the order BASE + ADDED, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE + ADDED}
    done = dict.fromkeys(BASE + ADDED, 0)  # up to where each kind has used the text
    seen = 0  # end of the digit run already looked at
    for last, (what, width) in anchors().iter(_lowered(t)):
        s = last - width + 1
        if what == "digit":
            if s < seen:
                continue
            seen = _run(t, s, DIGITS)
            if s >= done["ip"]:
                if hit := _ip(t, s):
                    done["ip"] = hit[0]
                    if hit[1]:
                        found["ip"].append((s, hit[0]))
            if s >= done["card"]:
                done["card"] = e = _card(t, s)
                digits = [c for c in t[s:e] if c in DIGITS]
                if 13 <= len(digits) <= 19 and luhn("".join(digits)):
                    found["card"].append((s, e))
            if s >= 2 and seen - s >= 2 and s - 2 >= done["iban"] and t[s - 1] in LETTERS and t[s - 2] in LETTERS and not (s > 2 and t[s - 3] in ALNUM):
                if e := _iban(t, s - 2):
                    done["iban"] = e
                    found["iban"].append((s - 2, e))
        elif what == "@":
            if hit := _email(t, s, done["email"]):
                done["email"] = hit[1]
                found["email"].append(hit)
        elif what == "+":
            if hit := _phone(t, s):
                if hit[1]:
                    found["phone"].append((s, hit[0]))
        elif what == "scheme":
            if s >= done["url"]:
                done["url"], personal = _url(t, s, last + 1)
                if personal:
                    found["url"].append((s, done["url"]))
        elif what == "cue":
            if not (s and t[s - 1] in LETTERS) and (hit := _account(t, last + 1)) and hit[0] >= done["account"]:
                done["account"] = hit[1]
                found["account"].append(hit)
        elif what == "key":
            if t[s:last + 1] in KEYS and s >= done["key"] and not (s and t[s - 1] in ALNUM):
                done["key"] = e = _run(t, s, KEY_CHARS)
                if e - s >= KEYS[t[s:last + 1]]:
                    found["key"].append((s, e))
        elif t[s:last + 1] in SPELLED:
            a = s - 1 if s and t[s - 1] == " " else s
            b = _run(t, last + 1, frozenset(" "))
            left = a
            while left > done["mail"] and t[left - 1] in LOCAL:
                left -= 1
            e = _run(t, b, LABEL | {"."})
            if left < a and "." in t[b:e].strip("."):
                done["mail"] = e
                found["mail"].append((left, e - (t[e - 1] == ".")))
    return [(k, a, b) for k in BASE + ADDED for a, b in found[k]]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of the base kinds, and all spans
    as kind:start:end, joined by commas.  A narrow map."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b[text]:
                all_spans = spans(t)
                said = [f"{k}:{s}:{e}" for k, s, e in all_spans]
                n = [sum(k == kind for k, _, _ in all_spans) for kind in BASE]
                rows.append((*n, hashlib.sha256(",".join(said[:sum(n)]).encode()).hexdigest(), ",".join(said)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            out.insert(0, key, b[key].to_numpy())
            yield out

    src = text_of(docs, key, text)
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(t: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    out, upto, stop = [], 0, 0
    for k, a, b in sorted(spans(t), key=lambda x: (x[1], -x[2])):
        if a >= stop:
            out += [t[upto:a], f"<{k.upper()}>"]
        upto = stop = max(stop, b)
    return "".join(out) + t[upto:] if out else t


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data masked in the text; null texts stay null, other columns are unchanged."""
    @F.pandas_udf("string")
    def mask(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else masked(t))

    return docs.withColumn(text, mask(F.col(f"`{text}`")))

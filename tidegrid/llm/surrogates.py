"""Personal data in texts, and the surrogates that stand in for it."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

# Titles with their gender, and given names by script and gender.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f", "Госпожа": "f", "Κυρία": "f",
    "Dr": "u", "Prof": "u",
}
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Andrew Hans Peter Klaus Jürgen Pierre Jean Jacques Michel José Carlos Miguel Antonio Mohammed Ahmed Wei Jun Raj Arjun Rahul Kenji Hiroshi Omar Yusuf Luca Marco Giovanni Lars Erik Piotr João".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Emily Anna Ursula Helga Monika Marie Sophie Camille Élise María Carmen Lucía Isabel Fatima Aisha Priya Anjali Mei Yuki Leila Zainab Giulia Chiara Francesca Ingrid Agnieszka Beatriz".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Николай Михаил Павел Андрей Владимир Олег".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Παναγιώτης Βασίλης".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Ιωάννα Δήμητρα".split(),
    ("armenian", "m"): "Արամ Տիգրան Հայկ Գևորգ".split(),
    ("armenian", "f"): "Անի Նարե Մարիամ Լուսինե".split(),
    ("georgian", "m"): "გიორგი ლევან დავით".split(),
    ("georgian", "f"): "ნინო თამარ ქეთევან".split(),
    ("hebrew", "m"): "דוד יוסף משה אברהם".split(),
    ("hebrew", "f"): "שרה רחל מרים לאה".split(),
    ("arabic", "m"): "محمد أحمد علي حسن".split(),
    ("arabic", "f"): "فاطمة عائشة مريم زينب".split(),
}
#: Letters that names of other scripts are made of: first and last of a range; those of a script without a range are of its first letter's block.
# fixed values
LETTERS = {"armenian": "աֆ", "georgian": "აჰ", "hebrew": "את", "arabic": "بي", "thai": "กฮ", "hangul": "가힣", "han": "一龥", "hiragana": "あん", "katakana": "アン"}
SYLLABLES = {
    "latin": "ba be bo da del do fa fer ga gor ha hol ka kel la lin lo ma mer mo na nel no pa per ra rin ro sa sel so ta ten to va ver vo wa wen".split(),
    "cyrillic": "ба бор ва вер га гор да дем ка кол ла лин ма мор на нов па пет ра ром са сор та тим фа фед".split(),
    "greek": "βα γα δα δη κα κο λα λι μα μη να νι πα πε ρα ρι σα σω τα τη φα φι".split(),
}
ENDING = {("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова", ("greek", "m"): "ης", ("greek", "f"): "η"}

_GENDER = {name.casefold(): g for (_, g), names in GIVEN.items() for name in names}
_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_WORD = re.compile(rf"\b{_NAME}\b")
_POSSESSIVE = re.compile("(?<=.)['’][sS]$")
_TITLED = re.compile(rf"\b({'|'.join(TITLES)})\.?[ \t]+({_NAME})(?:[ \t]+({_NAME}))?")
# a word that does not begin in lower case, before another; which ones are given names is looked up
_NO_SMALL = r"[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώա-և]"
_FIRST = re.compile(rf"\b({_NO_SMALL}[^\W\d_]*)[ \t]+(?={_NO_SMALL})")
_SECOND = re.compile(_NAME)
#: Length of an IBAN by country.
IBAN_LENGTH = {
    c: int(n)
    for n, found in (x.split(":") for x in "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD,FK 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK,MN 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,TL,SO 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU".split())
    for c in found.split(",")
}
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}))")
_RUN = re.compile(r"(?<![\w.-])\d+(?:[ -]\d+)+(?![\w-])")
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
_IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{3,39}(?![\w:])")
# a national number: 0 and an area code, a sign, the rest in one piece or with more signs
_NATIONAL = re.compile(r"(?<![\w+./-])(?:\(0\d{1,4}\)[ /-]?|0\d{1,4}(?:[/-]| / | - ))\d{2,8}(?:[ -]\d{2,5}){0,2}(?![\w/:-])")
_NUMBERS = [
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])")),
]


@cache
def script(word: str) -> str:
    """The script of a word's first letter, by the first word of its Unicode name."""
    c = next((c for c in word if c.isalpha()), "a")
    named = unicodedata.name(c, "LATIN").split()[0].lower()
    return {"cjk": "han"}.get(named, named)


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _valid(kind: str, text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "ipv6":
        try:
            # names of code have such signs, too; 0 and 1 are no one's address
            return any(c.isdigit() for c in text) and int(ipaddress.IPv6Address(text)) > 1
        except ValueError:
            return False
    if kind == "card":
        return luhn(digits) and len(set(digits)) > 1
    if kind == "iban":
        return _mod97(text.replace(" ", "")) == 1
    return kind != "phone" or 9 <= len(digits) <= 15


def _ibans(text: str) -> list[tuple[int, int]]:
    """Valid IBANs: first those of their country's length, then the longest valid ones that end with a word."""
    starts = [m.span(1) for m in _IBAN.finditer(text)]
    found: list[tuple[int, int]] = []
    for known in (True, False):
        for start, last in starts:
            for stop in range(last, start + 14, -1):
                after = text[stop : stop + 1]
                if text[stop - 1] == " " or after.isascii() and after.isalnum() or any(start < b and a < stop for a, b in found):
                    continue
                value = text[start:stop].replace(" ", "")
                if known and len(value) != IBAN_LENGTH.get(value[:2]) or not 15 <= len(value) <= 34:
                    continue
                if _valid("iban", value):
                    found.append((start, stop))
                    break
    return found


def _cards(text: str) -> list[tuple[int, int]]:
    """Valid card numbers among groups of digits.

    Windows of 13 to 19 digits in groups as cards have them come first, then any whose
    groups but the last have four digits or more; those of one rank that overlap are
    merged, so no digit of either stays.
    """
    ranks: tuple[list[tuple[int, int]], ...] = ([], [])
    for run in _RUN.finditer(text):
        groups = [(run.start() + g.start(), run.start() + g.end()) for g in re.finditer(r"\d+", run[0])]
        for i, (start, _) in enumerate(groups):
            lengths: list[int] = []
            for a, stop in groups[i : i + 5]:
                lengths.append(stop - a)
                if sum(lengths) > 19:
                    break
                if sum(lengths) >= 13 and min(lengths[:-1], default=4) >= 4 and _valid("card", text[start:stop]):
                    usual = len(lengths) == 1 or lengths in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4])
                    ranks[not usual].append((start, stop))
    found: list[tuple[int, int]] = []
    for windows in ranks:
        merged: list[tuple[int, int]] = []
        for start, stop in sorted(windows):
            if any(start < b and a < stop for a, b in found):
                continue
            if merged and start < merged[-1][1]:
                start, stop = merged[-1][0], max(stop, merged.pop()[1])
            merged.append((start, stop))
        found += merged
    return found


def _nationals(text: str) -> Iterator[tuple[int, int]]:
    """National numbers: only where a 0 stands they can begin."""
    i = text.find("0")
    while i >= 0:
        m = _NATIONAL.match(text, i - 1 if i and text[i - 1] == "(" else i)
        if m:
            yield m.span()
        i = text.find("0", m.end() if m else i + 1)


def normal(kind: str, text: str) -> str:
    """What mentions of one entity have in common."""
    if kind == "ip":
        return text
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).exploded
    if kind in ("iban", "card", "ssn", "phone"):
        return re.sub(r"[^A-Z0-9+]", "", text)
    return text.casefold()


def _cased(word: str) -> bool:
    return word[0].isupper()


def _uncased(word: str) -> bool:
    """Whether a word is of a script without capitals."""
    return word[0].isalpha() and word[0] == word[0].lower() == word[0].title()


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """``start, stop, kind, normal form`` of the entities of a text, in order, without overlaps.

    Names are split into given name and surname, so that mentions by surname only
    keep referring to the same person. A kind of name tells gender and script.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(*m.span(), "email", m[0]) for m in _EMAIL.finditer(text)]
    if re.search(r"\d", text):
        found += [(a, b, "iban", text[a:b]) for a, b in _ibans(text)]
        found += [(a, b, "card", text[a:b]) for a, b in _cards(text)]
        if "::" in text or text.count(":") >= 7:
            found += [(*m.span(), "ipv6", m[0]) for m in _IPV6.finditer(text) if _valid("ipv6", m[0])]
        for kind, pattern in _NUMBERS:
            if kind == "phone":
                found += [(a, b, kind, text[a:b]) for a, b in _nationals(text) if _valid(kind, text[a:b])]
            found += [(*m.span(), kind, m[0]) for m in pattern.finditer(text) if _valid(kind, m[0])]
    for m in _TITLED.finditer(text):
        first, second = m[2], m[3]
        if _uncased(first):
            second = None  # where names have no capital, the next word may be any
        elif not _cased(first):
            continue
        if second and _cased(second):
            gender = _GENDER.get(first.casefold(), TITLES[m[1]])
            found += [(*m.span(2), f"given {gender} {script(first)}", first), (*m.span(3), f"surname {gender} {script(second)}", second)]
        elif (g := _GENDER.get(first.casefold())) is not None:
            found.append((*m.span(2), f"given {g} {script(first)}", first))
        else:
            found.append((*m.span(2), f"surname {TITLES[m[1]]} {script(first)}", first))
    after = 0
    for m in _FIRST.finditer(text):
        gender = _GENDER.get(m[1].casefold())
        if gender is None or m.start() < after or not (second := _SECOND.match(text, m.end())):
            continue
        after = second.end()
        if _uncased(m[1]):
            found.append((*m.span(1), f"given {gender} {script(m[1])}", m[1]))
        elif _cased(m[1]) and _cased(second[0]):
            found += [(*m.span(1), f"given {gender} {script(m[1])}", m[1]), (*second.span(), f"surname {gender} {script(second[0])}", second[0])]
    # a surname that was found stands for its person wherever it is a word of its own
    bare: dict[str, str] = {}
    for _, _, kind, value in found:
        if kind.startswith("surname") and len(value) > 1:
            bare.setdefault(_POSSESSIVE.sub("", value).casefold(), kind)
    if bare:
        words = ((m.start(), _POSSESSIVE.sub("", m[0])) for m in _WORD.finditer(text))
        found += [(i, i + len(w), bare[w.casefold()], w) for i, w in words if (_cased(w) or _uncased(w)) and w.casefold() in bare]
    out: list[tuple[int, int, str, str]] = []
    starts: list[int] = []
    stops: list[int] = []
    for start, stop, kind, value in found:  # kinds found first win; those that stay do not overlap, so both lists ascend
        i = bisect_left(stops, start + 1)
        if i == len(starts) or stop <= starts[i]:
            starts.insert(i, start)
            stops.insert(i, stop)
            out.append((start, stop, kind, normal(kind, value)))
    return sorted(out)


#: Attempts after which numbers leave their reserved ranges, and after which there is no surrogate.
WIDE, LAST = 16, 64


class Draw:
    """A keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, *what: object) -> None:
        self.key, self.what, self.held, self.n = key, "\x1f".join(map(str, what)), b"", 0

    def below(self, n: int) -> int:
        if len(self.held) < 8:
            self.held += hmac.digest(self.key, f"{self.what}\x1f{self.n}".encode("utf-8", "surrogatepass"), hashlib.sha256)
            self.n += 1
        value, self.held = int.from_bytes(self.held[:8]), self.held[8:]
        return value % n

    def digits(self, like: str) -> str:
        return "".join(str(self.below(10)) if c.isdigit() else chr(65 + self.below(26)) if c.isalpha() else c for c in like)

    def syllables(self, n: int, kind: str) -> str:
        if kind not in SYLLABLES:
            first, last = map(ord, LETTERS.get(kind, "az"))
            made = (chr(first + self.below(last - first + 1)) for _ in range(n if kind in ("han", "hangul") else 2 * n))
            # places of a block that are no letter give way to its first
            return "".join(c if c.isalpha() else chr(first) for c in made)
        return "".join(SYLLABLES[kind][self.below(len(SYLLABLES[kind]))] for _ in range(n))


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A replacement in normal form; later attempts draw from larger spaces."""
    draw = Draw(key, kind.split()[0], value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        # one domain has one surrogate domain, reserved for examples, until attempts run out
        host = Draw(key, "domain", domain, attempt // 8).syllables(3 + attempt // 8, "latin")
        name = "".join(str(draw.below(10)) if c.isdigit() else chr(97 + draw.below(26)) if c.isalpha() else c for c in local)
        ending = domain.rpartition(".")[2]
        # fixed values: of the endings below these, example.<ending> is reserved, and so is the ending "example"
        return f"{name}{draw.syllables(attempt // 2, 'latin')}@{host}.example{f'.{ending}' if ending in ('com', 'net', 'org') else ''}"
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        private = octets[0] == 10 or octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32
        first = 10 if private and attempt < WIDE else (lambda x: x + (x >= 10) + (x >= 126))(1 + draw.below(221))
        return ".".join(map(str, (first, draw.below(256), draw.below(256), 1 + draw.below(254))))
    if kind == "ipv6":
        # fixed values: fd00::/8 is for private networks, 2001:db8::/32 for examples
        own = value[:2] in ("fc", "fd")
        groups = [f"fd{draw.below(256):02x}"] if own else ["2001", "0db8"]
        return ":".join([*groups, *(f"{draw.below(65536):04x}" for _ in range(8 - len(groups)))])
    if kind == "card":
        body = value[0] + draw.digits(value[1:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "ssn":  # areas from 900 are never issued
        area = f"9{draw.digits('00')}" if attempt < WIDE else f"{1 + draw.below(899):03d}"
        return f"{area}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "iban":
        body = draw.digits(value[4:])
        return f"{value[:2]}{98 - _mod97(value[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        if re.fullmatch(r"\+1\d{10}|[1-9]\d{9}", value) and attempt < 6:  # exchange 555 is kept free
            return f"{value[:-10]}{2 + draw.below(8)}{draw.digits('00')}555{draw.digits('0000')}"
        code = value[:3] if value[0] == "+" else "0" if value[0] == "0" else ""
        return f"{code}{1 + draw.below(9)}{draw.digits('0' * (len(value) - len(code) - 1))}"
    part, gender, letters = kind.split()
    if part == "given":
        names = GIVEN.get((letters, gender), []) if gender != "u" else GIVEN.get((letters, "m"), []) + GIVEN.get((letters, "f"), [])
        if not names:
            return draw.syllables(2 + attempt // 3, letters)
        name = names[draw.below(len(names))]
        return (name if attempt < 2 else f"{name}-{draw.syllables(2 + attempt // 3, letters)}").casefold()
    return (draw.syllables(2 + attempt // 3 + draw.below(2), letters) + ENDING.get((letters, gender), "")).casefold()


def shaped(kind: str, stand_in: str, mention: str) -> str:
    """A surrogate in the format of the mention it replaces: its separators and its case."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(stand_in)
        return "".join(next(left, "") if c.isalnum() or c == "+" else c for c in mention)
    if kind == "ipv6":
        # as many groups are written as before; the rest becomes the gap
        groups = stand_in.split(":")
        if "::" in mention:
            head, tail = (len(x.split(":")) if x else 0 for x in mention.split("::"))
            head = max(head, 2)
            stand_in = ":".join(groups[:head]) + "::" + ":".join(groups[8 - tail :] if tail else [])
        short = ":".join(g.lstrip("0") or ("0" if g else "") for g in stand_in.split(":")) if mention != ipaddress.IPv6Address(mention).exploded else stand_in
        return short.upper() if any(c.isupper() for c in mention) else short
    if mention.isupper() and len(mention) > 1:
        return stand_in.upper()
    if kind.startswith(("given", "surname")):
        return "-".join(x.capitalize() for x in stand_in.split("-"))
    return stand_in


def splice(text: str, edits: Iterator[tuple[int, int, str, str]]) -> str:
    """The text with each ``start, stop, kind, surrogate`` put in."""
    out, at = [], 0
    for start, stop, kind, stand_in in edits:
        out += [text[at:start], shaped(kind, stand_in, text[start:stop])]
        at = stop
    return "".join([*out, text[at:]])

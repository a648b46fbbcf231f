"""Places of personal information in one text: forms, contexts and the decision by a learned model."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

# Words around names and numbers in the corpus' languages.
TITLES = {
    "dr", "dra", "prof", "profa", "mr", "mrs", "ms", "miss", "mx", "sir", "herr", "frau", "hr", "fr", "mme", "mlle", "monsieur", "madame", "m",
    "sr", "sra", "srta", "don", "doña", "señor", "señora",
}
PHONE_CUES = {
    "tel", "telephone", "phone", "call", "fax", "mobile", "cell", "telefon", "handy", "anrufen", "rufnummer", "teléfono", "telefono", "llamar",
    "móvil", "téléphone", "appeler", "portable", "telefone", "celular", "whatsapp", "telefoon",
}
ID_CUES = {
    "passport", "ssn", "security", "identity", "card", "mrn", "ausweis", "ausweisnummer", "personalausweis", "reisepass", "reisepassnummer", "documento",
    "dni", "pasaporte", "passeport", "nif", "nie", "nir", "insurance", "personnummer", "bsn", "cpf", "versichertennummer", "sozialversicherungsnummer",
    "steuernummer", "cédula", "identité",
}
_HAN_CUE = re.compile(r"(?P<phone>电话|手机|传真)|(?P<id>护照|身份证|证件|病历号)")
STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Court|Ct|Drive|Dr|Square|Sq|Terrace|Close|Way|Boulevard|Blvd|Row|Crescent|Hill|Walk|Place|Pl|Parkway|Highway"

_AT = r"(?: ?[@＠] ?| ?\[ ?at ?\] ?| ?\( ?at ?\) ?| ?\{ ?at ?\} ?| AT | at (?=[\w-]+ dot ))"
_DOT = r"(?:\.| ?\[ ?dot ?\] ?| ?\( ?dot ?\) ?| ?\{ ?dot ?\} ?| DOT | dot )"
EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9À-ɏ](?:[A-Za-z0-9À-ɏ._%+'-]*[A-Za-z0-9À-ɏ_+-])?{_AT}[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9@])",
    re.I,
)
_MAYBE_EMAIL = re.compile(r"[@＠]|[\[({] ?at ?[\])}]|dot", re.I)
_EXT = r"(?:,? ?(?:ext\.?|extension|x|Durchwahl|poste|extensión) ?\d{1,6})"
# Anything that looks like a number of several digits: groups with one separator between them, letters before or behind.
_GROUPS = r"\(?\d+(?:(?:\)[ .-]?|[ .-]?\(|[ ./-])\d+){0,8}"
NUMBER = re.compile(
    rf"(?<![\w+./:#@-])(?:(?P<mark>[A-Z]{{1,4}})(?: ?[-:#]? ?){_GROUPS}(?:[ -]?[A-Z](?![A-Za-z]))?|\+?{_GROUPS}(?:{_EXT}|-?[A-Z](?![A-Za-z]))?)(?![\w]|[-./:]\w)"
)
_SHAPE = str.maketrans("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "9" * 10 + "A" * 26)
_EXTENDED = re.compile(rf"{_EXT}\Z")
LEAST_DIGITS, MOST_DIGITS = 6, 22
_CAP = r"[A-ZÀ-Þ][a-zà-ÿ]+"
TOWN = rf"{_CAP}(?:[ -](?:{_CAP}|am|an|der|de|la|le|les|sur|del)){{0,3}}"
_CODE = r"\d{4,6}"
_NUMBER = r"\d{1,5}(?:[A-Za-z](?![A-Za-z])|[ -]?(?:bis|ter))?"
_UNIT = r"(?:,? (?:Flat|Apt\.?|Apartment|Unit|Suite|Room|Floor|#) ?\w+)?"
_QUARTER = r"(?: (?:NW|NE|SW|SE|N|S|E|W))?"
_CLOSING = rf"(?P<code>(?:,? [A-Z]{{2}})?,? {_CODE}\b)?"
_STREETWORD = rf"{_NUMBER} (?:{_CAP} ){{0,3}}(?P<street>{_CAP}){_QUARTER}\.?{_UNIT}, (?P<town>{TOWN}){_CLOSING}"
_FORMS = [
    rf"{_NUMBER} (?:{_CAP} ){{1,3}}(?:{STREETS})\b{_QUARTER}\.?{_UNIT}, (?P<town>{TOWN}){_CLOSING}",
    rf"(?:P\.? ?O\.? ?Box|Postfach|Apartado|Boîte postale|BP) \d+, (?:(?P<precode>{_CODE}) )?(?P<town>{TOWN})(?P<code>,? {_CODE}\b)?",
    rf"(?:{_CAP}[ -])?[A-ZÄÖÜ][a-zäöüß]+(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm|ring) ?{_NUMBER}, (?P<precode>{_CODE}) (?P<town>{TOWN})",
    rf"(?:[A-ZÄÖÜ][a-zäöüß]+[ -]){{1,2}}(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee) {_NUMBER}, (?P<precode>{_CODE}) (?P<town>{TOWN})",
    rf"(?:Calle|Avenida|Avda\.|Av\.|Plaza|Paseo|Camino|C/)(?: [A-Za-zÀ-ÿ]+){{1,5}},? {_NUMBER}, (?P<precode>{_CODE}) (?P<town>{TOWN})",
    rf"{_NUMBER},? (?:rue|avenue|boulevard|place|quai|chemin|impasse|allée|cours|square)(?: [A-Za-zÀ-ÿ'’-]+){{1,6}}, (?P<precode>{_CODE}) (?P<town>{TOWN})",
    # Whatever the words: a house number behind them, then postcode and town.
    rf"(?:{_CAP}[ -]){{0,3}}{_CAP} {_NUMBER}, (?:[A-Z]{{1,2}}-)?(?P<precode>{_CODE}) (?P<town>{TOWN})",
]
ADDRESSES = [re.compile(rf"(?<![\w.:-]){a}") for a in _FORMS]
STREETWORD = re.compile(rf"(?<![\w.:-]){_STREETWORD}")
HAN_ADDRESS = re.compile(r"[\u4e00-\u9fff]{2,8}(?:省|市|区|县)[\u4e00-\u9fff]{1,12}(?:路|街|道|巷) ?\d{1,5} ?号(?: ?\d{1,4} ?[室楼栋])*")
_MAYBE_ADDRESS = re.compile(r", (?:[A-ZÀ-Þ][a-zà-ÿ]|(?:[A-Z]{1,2}-)?\d{4})")

# Frequent family names in Han letters, words around names written so.
_HAN_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
_HAN_TITLE, _HAN_LABEL = "先生|女士|小姐|博士|教授|医生|老师|主任", "姓名|联系人|患者|负责人|签名|收件人"
HAN = re.compile(r"[\u4e00-\u9fff]")
HAN_NAMED = re.compile(
    rf"(?<![\u4e00-\u9fff])(?P<a>[{_HAN_FAMILY}][\u4e00-\u9fff]{{1,2}})(?=(?:{_HAN_TITLE}))|(?P<b>[{_HAN_FAMILY}][\u4e00-\u9fff]{{1,2}}?)(?=(?:{_HAN_TITLE}))|(?:{_HAN_LABEL})[:： ] ?(?P<c>[{_HAN_FAMILY}][\u4e00-\u9fff]{{1,2}})(?![\u4e00-\u9fff])"
)
HAN_MAYBE = re.compile(rf"(?=([{_HAN_FAMILY}][\u4e00-\u9fff]{{1,2}}))")

_NAME = r"(?:[A-ZÀ-Þ][a-zà-ÿ]+|[A-ZÀ-Þ]{3,})"
ITEM = re.compile(rf"(?<![\w@%$])(?:(?P<name>{_NAME}(?:-{_NAME})*)(?![\w@]|-\w)|(?P<initial>[A-ZÀ-Þ]\.)(?!\w*@)(?=[ ,;)\n\"]|{_NAME}|[A-ZÀ-Þ]\.|$|\W))")
LOWER = re.compile(r"(?<![\w@./_=-])[a-zà-ÿ]{3,}(?![\w@/_=(]|[.-]\w)")
TOKEN = re.compile(r"[A-Za-zÀ-ÿ]+|\d+|\n|[^\w\s]|[^\W\d_]")
_CAPITAL_END = re.compile(r"[A-ZÀ-Þ][A-Za-zà-ÿ]+ ?[,(] ?\Z")
_OPENS = {".", "!", "?", "<s>", "。", "！", "？"}


@dataclass
class Model:
    """What was learned: names, other words that label things, towns, street words; for phones and numbers of persons the
    shapes that tell alone, those that tell in a known context, and the contexts; contexts of people."""

    name: set[str] = field(default_factory=set)
    either: set[str] = field(default_factory=set)
    town: set[str] = field(default_factory=set)
    street: set[str] = field(default_factory=set)
    phone: set[str] = field(default_factory=set)
    phone_shape: set[str] = field(default_factory=set)
    phone_maybe: set[str] = field(default_factory=set)
    id: set[str] = field(default_factory=set)
    id_shape: set[str] = field(default_factory=set)
    id_maybe: set[str] = field(default_factory=set)
    person: set[str] = field(default_factory=set)


class Tokens:
    """The tokens of a text, cut when they are first asked for; numbers as 9, ``<s>`` for the start of the text or a line."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def starts(self) -> list[int]:
        return [m.start() for m in TOKEN.finditer(self.text)]

    @cached_property
    def words(self) -> list[str]:
        return TOKEN.findall(self.text)

    def at(self, i: int) -> str:
        if not 0 <= i < len(self.words) or (w := self.words[i]) == "\n":
            return "<s>"
        return "9" if w.isdigit() else w.lower()

    def left(self, place: int, n: int = 2) -> list[str]:
        i = bisect_left(self.starts, place)
        return [self.at(k) for k in range(i - n, i)]

    def right(self, place: int, n: int = 2) -> list[str]:
        i = bisect_left(self.starts, place)
        return [self.at(k) for k in range(i, i + n)]


def patterns(tokens: Tokens, start: int, end: int) -> list[str]:
    """Lexical patterns of the place of a possible name."""
    (l2, l1), (r1, r2) = tokens.left(start), tokens.right(end)
    return [f"{l2} {l1} _", f"_ {r1} {r2}", f"{l1} _ {r1}"]


def context(text: str, tokens: Tokens, start: int) -> str:
    """What stands before a number: two tokens, or one where the token before that may be anything."""
    before, last = tokens.left(start)
    if last == "<s>":
        return last
    if last in (",", "(") and _CAPITAL_END.search(text[max(0, start - 32) : start]):
        return f"Aa {last}"
    return f"{before} {last}"


def cue(tokens: Tokens, start: int) -> str:
    """'phone' or 'id' if a word for it stands before a number, with no other number between."""
    i = bisect_left(tokens.starts, start)
    for k in range(i - 1, max(i - 8, -1), -1):
        w = tokens.at(k)
        if w == "9":
            break
        if w in PHONE_CUES:
            return "phone"
        if w in ID_CUES:
            return "id"
    before = tokens.text[max(0, start - 8) : start]
    said = [m.lastgroup for m in _HAN_CUE.finditer(before)] if HAN.search(before) else []
    return said[-1] if said and not re.search(r"\d", before) else ""


def shape(number: str, mark: str | None) -> str:
    """Digits as 9, letters as A, without extension; the mark of a patient's record and a leading 00 as they are."""
    if mark == "MRN":
        return mark
    bare = _EXTENDED.sub("", number).translate(_SHAPE)
    return f"00{bare[2:]}" if re.match("00[1-9]", number) else bare


def sure(form: str) -> str:
    """'phone' for a number with an international prefix, 'id' for one with the mark of a patient's record; else ''."""
    return "id" if form == "MRN" else "phone" if form[0] == "+" or form.startswith("009") and len(re.findall(r"\D", form)) > 1 else ""


@dataclass
class Unit:
    """Capitalised words and initials in a row; titles before them are left out."""

    items: list[tuple[int, int, str, bool]]  # start, end, text, initial
    titled: bool

    @property
    def start(self) -> int:
        return self.items[0][0]

    @property
    def end(self) -> int:
        return self.items[-1][1]


def units(text: str, taken: list[tuple[int, int]]) -> Iterator[Unit]:
    items: list[tuple[int, int, str, bool]] = []
    blocked = iter([*taken, (1 << 60, 1 << 60)])
    low, high = next(blocked)

    def finish() -> Iterator[Unit]:
        part, titled = list(items), False
        while part and not part[0][3] and part[0][2].lower() in TITLES:
            titled = True
            part.pop(0)
        items.clear()
        if part and not all(i for *_, i in part):
            yield Unit(part, titled)

    for m in ITEM.finditer(text):
        start, end = m.span()
        while high <= start:
            low, high = next(blocked)
        if end > low:
            yield from finish()
            continue
        item = (start, end, m[0], m["initial"] is not None)
        if items:
            last = items[-1]
            gap = text[last[1] : start]
            title = last[2].lower() in TITLES and not last[3]
            if not title and not item[3] and item[2].lower() in TITLES:
                yield from finish()  # a title begins another name
            joined = gap == " " or title and gap == ". " or (last[3] or item[3]) and gap == "" or item[3] and gap == ", " and not last[3]
            if not joined:
                yield from finish()
        items.append(item)
    yield from finish()


def words_of(item: str) -> list[str]:
    return [w.lower() for w in item.split("-")]


@dataclass
class Forms:
    """Places that look like something: emails; numbers with their shape; addresses with town, whether the end is certain, street word (None: known)."""

    emails: list[tuple[int, int]]
    numbers: list[tuple[int, int, str]]
    addresses: list[tuple[int, int, str, bool, str | None]]


def _free(s: int, e: int, spans: list) -> bool:
    return all(e <= x[0] or x[1] <= s for x in spans)


def forms(text: str) -> Forms:
    emails = [m.span() for m in EMAIL.finditer(text)] if _MAYBE_EMAIL.search(text) else []
    numbers = []
    for m in NUMBER.finditer(text):
        s, e = m.span()
        if e - s >= LEAST_DIGITS and LEAST_DIGITS <= sum(map(str.isdigit, m[0])) <= MOST_DIGITS and _free(s, e, emails):
            numbers.append((s, e, shape(m[0], m["mark"])))
    addresses: list[tuple[int, int, str, bool, str | None]] = []
    if _MAYBE_ADDRESS.search(text):
        for p in ADDRESSES:
            for m in p.finditer(text):
                g = m.groupdict()
                if _free(*m.span(), addresses) and _free(*m.span(), emails):
                    addresses.append((*m.span(), m["town"], bool(g.get("code")) and not g.get("precode"), None))
        for m in STREETWORD.finditer(text):
            if _free(*m.span(), addresses) and _free(*m.span(), emails):
                addresses.append((*m.span(), m["town"], bool(m["code"]), m["street"].lower()))
    return Forms(emails, numbers, addresses)


def town_of(town: str, model: Model | None) -> str:
    """The leading words of a capitalised run that are a town: the longest known one, else the first word and what it needs."""
    parts = re.findall(r"[^ ]+", town)
    if model:
        for n in range(len(parts), 0, -1):
            if " ".join(parts[:n]) in model.town:
                return " ".join(parts[:n])
    n = 2 if len(parts) > 1 and parts[0] in ("Bad", "Port", "Saint", "Sankt", "San", "Santa", "New", "Old", "Los", "Las", "La", "Le", "El", "North", "South", "East", "West", "Mount", "Fort", "Lake", "Upper", "Lower", "Great", "Little", "Ciudad", "Villa") else 1
    return " ".join(parts[:n])


def _fitting(address: tuple, model: Model | None) -> tuple[int, int]:
    start, end, town, closed, _ = address
    return (start, end) if closed else (start, end - len(town) + len(town_of(town, model)))


def kind_of(text: str, tokens: Tokens, start: int, form: str, model: Model) -> str:
    """'phone', 'id' or '' for a number."""
    if form in model.id_shape or sure(form) == "id":
        return "id"
    if form in model.phone_shape or sure(form) == "phone":
        return "phone"
    maybe_id, maybe_phone = form in model.id_maybe, form in model.phone_maybe
    if maybe_id or maybe_phone:
        said = cue(tokens, start)
        around = None if said else context(text, tokens, start)
        if maybe_id and (said == "id" or around in model.id):
            return "id"
        if maybe_phone and (said == "phone" or around in model.phone):
            return "phone"
    return ""


def parts_of(text: str, start: int, end: int, form: str) -> Iterator[tuple[int, int, str]]:
    """A number, then its parts between blanks, from the left, for numbers may stand side by side."""
    yield start, end, form
    pieces = [(m.start() + start, m.end() + start) for m in re.finditer(r"[^ ]+", text[start:end])]
    if len(pieces) > 1:
        for n in range(len(pieces) - 1, 0, -1):
            for i in range(len(pieces) - n + 1):
                s, e = pieces[i][0], pieces[i + n - 1][1]
                yield s, e, shape(text[s:e], None)


def people(text: str, tokens: Tokens, taken: list[tuple[int, int]], model: Model) -> Iterator[tuple[int, int]]:
    for unit in units(text, taken):
        if not unit.titled and len(unit.items) == 1 and not any(w in model.name or w in model.either for w in words_of(unit.items[0][2])):
            continue  # nothing below could make it a name
        found = patterns(tokens, unit.start, unit.end)
        expected = unit.titled or sum(p in model.person for p in found) >= 2
        known = [i or any(w in model.name for w in words_of(t)) for _, _, t, i in unit.items]
        maybe = [k or (expected and any(w in model.either for w in words_of(t))) for k, (_, _, t, _) in zip(known, unit.items)]
        near = unit.titled or any(p in model.person for p in found)
        real = [n for n, x in enumerate(unit.items) if not x[3]]
        if near and len(real) > 1:  # an unseen name beside a known one, or before an initial, where people are named
            a, b = real[-2:]
            if known[a] and not known[b] or known[b] and not known[a] and unit.items[a][2].isupper():
                maybe[a] = maybe[b] = True
        if near and not any(known[n] for n in real) and unit.items[-1][3] and len(unit.items) > 1:
            maybe[real[-1]] = True
        if not any(m and not x[3] for m, x in zip(maybe, unit.items)):
            if unit.titled or expected and len(unit.items) == 2 and not any(w in model.either for *_, t, _ in unit.items for w in words_of(t)):
                maybe = [True] * len(unit.items) if len(unit.items) < 4 else maybe  # unseen names where people are named
            if not unit.titled and tokens.left(unit.start, 1)[0] in _OPENS:
                continue
        i = 0
        while i < len(unit.items):
            if not maybe[i]:
                i += 1
                continue
            j = i
            while j < len(unit.items) and maybe[j]:
                j += 1
            run = unit.items[i:j]
            names = [x for x in run if not x[3]]
            follows = unit.items[j] if j < len(unit.items) else None
            label = follows is not None and len(names) == 1 and not follows[3] and text[run[-1][1] : follows[0]] == " "
            while run and run[-1][3] and not names:
                run.pop()
            if names and not label:
                yield run[0][0], run[-1][1]
            i = j
    if not model.name.isdisjoint(LOWER.findall(text)):
        for m in LOWER.finditer(text):
            if m[0] in model.name and _free(*m.span(), taken):
                yield m.span()
    if HAN.search(text):
        named = [m.span(m.lastgroup) for m in HAN_NAMED.finditer(text)]
        yield from (x for x in named if _free(*x, taken))
        for m in HAN_MAYBE.finditer(text):
            s, e = m.span(1)
            for end in (e, s + 2):
                if text[s:end] in model.name and _free(s, end, taken) and _free(s, end, named):
                    named.append((s, end))
                    yield s, end


def find(text: str, model: Model) -> list[tuple[str, int, int]]:
    """kind, start, end of every place, in order and without overlap."""
    found, tokens = forms(text), Tokens(text)
    out = [("email", s, e) for s, e in found.emails]
    free = lambda s, e: all(e <= a or b <= s for _, a, b in out)
    phones = []
    for number in found.numbers:
        taken: list[tuple[int, int]] = []
        for s, e, form in parts_of(text, *number):
            digits = sum(map(str.isdigit, text[s:e]))
            kind = kind_of(text, tokens, s, form, model) if digits >= LEAST_DIGITS and _free(s, e, taken) else ""
            if kind == "id" and free(s, e):
                out.append(("id_number", s, e))
            elif kind == "phone":
                phones.append((s, e))
            if kind:
                taken.append((s, e))
                if (s, e) == number[:2]:
                    break
    for a in found.addresses:
        s, e = _fitting(a, model)
        if free(s, e) and (a[4] is None or a[4] in model.street):
            out.append(("address", s, e))
    if HAN.search(text):
        out += [("address", *m.span()) for m in HAN_ADDRESS.finditer(text) if free(*m.span())]
    out += [("phone", s, e) for s, e in phones if free(s, e)]
    out += [("person", s, e) for s, e in people(text, tokens, sorted((s, e) for _, s, e in out), model)]
    return sorted(set(out), key=lambda x: (x[1], x[2]))


def asked(text: str) -> set[str]:
    """Every entry of a model that ``find`` may look up for a text."""
    found, tokens = forms(text), Tokens(text)
    out = set(LOWER.findall(text)) | {m[1][:n] for m in HAN_MAYBE.finditer(text) for n in (2, 3)}
    for number in found.numbers:
        for s, _, form in parts_of(text, *number):
            out |= {form, context(text, tokens, s)}
    for _, _, town, _, word in found.addresses:
        parts = town.split(" ")
        out |= {" ".join(parts[:n]) for n in range(1, len(parts) + 1)} | {word or ""}
    for taken in ([], sorted(found.emails), sorted(found.emails + [a[:2] for a in found.addresses])):
        for unit in units(text, taken):
            out.update(patterns(tokens, unit.start, unit.end), *(words_of(t) for *_, t, _ in unit.items))
    return out | {w for m in ITEM.finditer(text) for w in words_of(m[0])}


class Seen:
    """What texts have to teach, counted: how words are written, patterns and words, numbers, towns, street words."""

    def __init__(self) -> None:
        self.low: Counter = Counter()  # words in lower case
        self.case: Counter = Counter()  # (word, cap|open)
        self.edge: Counter = Counter()  # (pattern, word)
        self.number: Counter = Counter()  # (context, cue, shape)
        self.town: Counter = Counter()
        self.street: Counter = Counter()  # (word or '' for a known one, context, closed by a postcode)

    def rows(self) -> Iterator[tuple[str, str, str, str, int]]:
        """kind, a, b, c, n."""
        yield from (("case", w, "low", "", n) for w, n in self.low.items())
        yield from (("case", w, how, "", n) for (w, how), n in self.case.items())
        yield from (("edge", p, w, "", n) for (p, w), n in self.edge.items())
        yield from (("number", *k, n) for k, n in self.number.items())
        yield from (("town", t, "", "", n) for t, n in self.town.items())
        yield from (("street", *k, n) for k, n in self.street.items())

    def add(self, text: str) -> None:
        found, tokens = forms(text), Tokens(text)
        taken = list(found.emails)
        for s, e, form in found.numbers:
            self.number[context(text, tokens, s), cue(tokens, s), form] += 1
            taken.append((s, e))
        for a in found.addresses:
            s, e, town, closed, word = a
            if closed and word is None:
                self.town[town] += 1
            self.street[word or "", " ".join(tokens.left(s)), "coded" if closed else ""] += 1
            if word is None:
                taken.append(_fitting(a, None))
        for unit in units(text, sorted(taken)):
            found_at = patterns(tokens, unit.start, unit.end)
            if unit.titled:
                found_at.append("<title> _")
            # The first of several capitalised words may only begin a sentence, unless a word or a comma stands before it.
            before = tokens.left(unit.start, 1)[0]
            opens = not unit.titled and len(unit.items) > 1 and before != "," and not before.isalpha()
            for n, (_, _, t, initial) in enumerate(unit.items):
                if initial:
                    continue
                for w in words_of(t):
                    self.case[w, "open" if opens and not n else "cap"] += 1
                    if n or not opens:
                        self.edge.update((p, w) for p in found_at)
        self.low.update(LOWER.findall(text))
        if HAN.search(text):
            for m in HAN_NAMED.finditer(text):
                self.case[m[m.lastgroup], "han"] += 1

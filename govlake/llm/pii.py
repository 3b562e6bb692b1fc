"""PII (4): surrogate generation with corpus-wide collision checks.

Detected entities are replaced by surrogates of the same type and format, made
from a keyed hash (HMAC-SHA-256) of the entity's canonical form. Equal entities
get equal surrogates wherever and however they are written (coreference);
different ones get different surrogates (distinctness). The latter is checked
over the corpus: Spark collects the distinct entities, and an entity whose
surrogate another one also has, or which is itself a real entity of the corpus,
tries again with the next number until none collides. From attempt ``WIDER`` on
surrogates get longer, so that every entity finds a free one however many real
entities share its format.

Kinds and what a surrogate keeps:

* email: lengths, character classes, case, the top-level domain and reserved
  example domains; a domain is an entity of its own, so one domain has one
  surrogate, no two domains share one, and none is a real domain of the corpus
* phone, ssn, card, ip: layout and digit counts; country code; the issuer digit
  and the Luhn check of a card; private address ranges (ssn: never-issued areas)
* iban: country, layout, valid check digits
* key, secret: vendor prefix, length, character classes; hexadecimal stays so
* given and family names (after a title or an introduction such as "my name
  is", or a known given name before a capitalised word): gender, script,
  capitals; parts are mapped one by one, particles and initials stay. Every
  other capitalised mention of a part in the same document is that name too

A null text stays null, an empty one empty. A very long text is one row of a task
and is replaced whole, in linear time. Repeated rows are replaced alike.
Texts without entities are returned unchanged, and all other columns as they
are, whatever their names, but for an ``n_replaced`` of the input, in whose place
the count comes. An empty table gives an empty result.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.llm.common import pick, stored, table

#: For tests and the registered query; a deployment passes its own.
DEMO_KEY = "not a secret: pass your own key"
#: Entities with a later attempt that are sent to the tasks; beyond it they are joined by row.
SENT = 100_000
#: From this attempt on a surrogate may be longer than its entity, and more so with each second one.
WIDER = 4

# Titles by gender, given names by script and gender, family names by script.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Sr", "Herr", "Monsieur", "Señor", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Lady", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "г-жа"),
    "n": ("Dr", "Prof", "Professor", "Doctor"),
}
GIVEN = {
    "latin": {
        "m": "James John Robert Michael David Thomas Daniel Hans Jürgen Klaus Pierre Jean Luc José Carlos Miguel".split(),
        "f": "Mary Patricia Jennifer Linda Susan Karen Sarah Ursula Sabine Heike Marie Camille Amélie Carmen Lucía Elena".split(),
        "n": "Robin Kim Alex Sascha Dominique Claude Noa Eden".split(),
    },
    "cyrillic": {"m": "Иван Пётр Сергей Андрей Николай Дмитрий".split(), "f": "Анна Мария Елена Ольга Татьяна Ирина".split(), "n": "Саша Женя Валя".split()},
}
FAMILY = {
    "latin": "Smith Johnson Brown Taylor Wilson Müller Schmidt Weber Wagner Martin Bernard Dubois Moreau García López Romero".split(),
    "cyrillic": "Иваненко Петренко Коваленко Шевченко Ткаченко Бондаренко".split(),
}
#: Given names that begin a person without a title; names that are common words (Will, Mark, May) are left out.
KNOWN = {
    "m": """Adam Adrian Ahmed Alan Albert Alejandro Alexander Alexandre Alfred Ali Álvaro Andreas Andrew Anthony Antoine Antonio Arthur Benjamin Bernd
        Brian Bruce Bruno Charles Christian Christopher Daniel David Dennis Diego Dieter Dmitri Donald Douglas Edward Emil Emmanuel Enrique Eric Erik Ethan
        Étienne Eduardo Felix Fernando Florian Francisco François Frank Frédéric Friedrich Fritz Gabriel Georg George Gerald Gerhard Guillaume Günter Günther Gustav
        Guy Harold Harry Heinrich Heinz Helmut Henri Henry Herbert Hermann Horst Hugo Ian Ignacio Igor Isaac Ivan Jacob Jacques Jakob James Jason Javier Jeffrey
        Jeremy Jerry Jesús Joachim Joaquín Johann Johannes John Jonas Jonathan Jorge Joseph Joshua Juan Julien Julio Justin Karl Kenneth Kevin Konrad Kurt Kyle
        Larry Laurent Lawrence Leon Leonard Lorenzo Louis Luca Lucas Luis Lukas Ludwig Manuel Marcel Marco Marcus Mario Martin Mathieu Matthew Matthias Maurice Max
        Maximilian Michel Mohamed Mohammed Muhammad Nathan Nicholas Nicolas Niklas Noah Olivier Oliver Oscar Otto Pablo Pascal Patrick Paul Pedro Peter Philip
        Philippe Philipp Rafael Rainer Ralph Ramón Raúl Raymond Ricardo Richard Rodrigo Roger Roland Ronald Rudolf Russell Ryan Samuel Scott Sean Sebastian
        Sergio Simon Stefan Stephen Stephan Steven Steve Theodor Theodore Thierry Timothy Tobias Tom Ulrich Uwe Vicente Victor Vincent Vladimir Walter Werner
        Wilhelm William Wolfgang Yves Zachary Александр Алексей Антон Борис Виктор Владимир Григорий Евгений Игорь Кирилл Максим Михаил Олег Павел Роман Юрий""",
    "f": """Abigail Adriana Agnes Aisha Alice Alicia Alison Amanda Amelia Amy Ana Andrea Angela Angelika Anja Anna Anne Annette Antje Barbara Beatrice Beatriz
        Birgit Brigitte Carla Carol Caroline Catherine Cécile Céline Chantal Charlotte Chloé Christine Claire Clara Claudia Cristina Cynthia Deborah Diana Donna
        Dorothy Elizabeth Elisabeth Élise Ella Emily Emma Erika Esther Eva Evelyn Fatima Franziska Frida Gabriela Gabriele Gisela Gloria Greta Hannah Helen Helena
        Helga Hélène Inés Inge Ingrid Irene Isabel Isabella Isabelle Jana Jane Janet Jessica Joanna Johanna Josephine Juana Judith Julia Julie Karin Katharina
        Katherine Kathleen Katrin Kimberly Kristin Laura Lena Léa Lisa Louise Lucie Lucy Luise Magdalena Manon Margaret Margarita María Maria Marta Martha Martina
        Mathilde Megan Melanie Melissa Mercedes Michelle Mia Monica Monika Monique Nadia Nancy Natalia Nathalie Nicole Nina Olivia Pamela Patricia Paula Paulina
        Petra Pilar Rachel Raquel Rebecca Renate Rita Rosa Ruth Samantha Sandra Sara Sharon Silvia Simone Sofia Sofía Sonia Sophia Sophie Stefanie Stephanie Susanne
        Sylvie Tanja Teresa Theresa Ute Valérie Vanessa Vera Verena Véronique Virginie Yolanda Yvonne Александра Анастасия Валентина Вера Виктория Галина Дарья
        Екатерина Ксения Людмила Марина Наталья Светлана Софья Юлия""",
}
GENDERS = {n: g for g, names in KNOWN.items() for n in names.split()} | {n: g for genders in GIVEN.values() for g, names in genders.items() for n in names}
#: As they begin a person; in capitals too, but for MAX.
BEGINS = frozenset(GENDERS) | {n.upper() for n in GENDERS if n != "Max"}
#: Capitalised words that end a name, and are no mention of one.
NO_NAME = frozenset(
    """The A An And Or But In On At Of For To From By With As Is Was Are Were Has Had Have He She It We They You I His Her Their My Our Your This That These Those Who
    When Where Why What How Not If So Then There Here After Before Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March June July September
    October November December Der Die Das Den Dem Ein Eine Und Oder Aber Im Am Ist War Hat Er Sie Es Wir Ihr Ich Nicht Mit Auf Für Von Zu Aus Bei Nach Le La Les Un
    Une Et Ou Mais Est Il Elle Nous Vous Je Ce Dans Pour Sur Avec De Du Des El Los Las Y O Pero Él Ella Con Para Por Del Van И В На Он Она Не Что Это""".split()
) | {t for ts in TITLES.values() for t in ts}
SYLLABLES = {"latin": "ba be bi bo da de do fa fe ga ka ke la le lo ma me mi na ne no ra re ri ro sa se ta te to va ve".split(), "cyrillic": "ба бе ва ве да де ка ко ла ле ма ми на не ра ро са се та то".split()}
ENDINGS = {"latin": {"m": "n", "f": "a", "n": "y", "": "s"}, "cyrillic": {"m": "н", "f": "а", "n": "я", "": "ко"}}

_octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_upper = "".join(c for c in map(chr, range(0x590)) if c.isupper())
# a capitalised word without its possessive; words in camel case or with digits are none
_name = rf"[{_upper}](?<![^\W_].)[^\W\d_]*(?:['’](?!s\b)[^\W\d_]+)*(?![^\W_])"
_lead = rf"(?:(?:van|von|zu|zur|vom|der|den|de|della|del|di|da|dos|do|du|la|le|el|al|bin|ibn|ter|ten|y|e|Van|Von|De|Du|La|Le|El|Al|Di|Da)[ ]|[{_upper}]\.[ ]?)"
NAME = re.compile(_name)
FIRST = re.compile(rf"{_lead}{{0,4}}({_name})")
NEXT = re.compile(rf"(?:[ ]{_lead}{{0,4}}|-)({_name})")
_titles = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
PATTERN = re.compile(
    rf"""
    (?<![A-Za-z])(?=[\w(+])(?:  # where any of them can begin
    (?P<email>(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
  | (?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
  | (?P<key>\b(?:(?:AKIA|ASIA)[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36,}}|sk-[A-Za-z0-9_-]{{20,}}|xox[baprs]-[\w-]{{10,}})(?![\w-]))
  | (?P<secret>(?<=[=:"'\s])(?<![\w])(?:(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{{32,}})(?!\w))
  | (?P<label>(?i:(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[:=]\s*["']?))(?P<value>[^\s"',;!<>]{{6,}})
  | (?P<ip>(?<![\w.]){_octet}(?:\.{_octet}){{3}}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
  | (?P<phone>(?<![\w+])(?<!\d[.,/-])(?:
        (?:\+|00(?=[1-9]))\d{{1,3}}[ ./-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ ./-]?\d{{2,4}}){{1,5}}
      | (?:1[ .-])?(?:\(\d{{3}}\)[ .-]?|[2-9]\d{{2}}[ .-])\d{{3}}[ .-]\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}|(?<!ISBN[ ])[2-9]\d{{9}}
      | 0[1-9](?:(?P<gap>[ .-])\d\d)(?:(?P=gap)\d\d){{3}}
      | \(0[1-9]\d{{1,3}}\)[ ]?\d{{3,8}}(?:[ -]\d{{2,4}}){{0,3}}
      | 0[1-9]\d{{1,4}}[ /-]\d{{3,8}}(?:[ -]\d{{2,4}}){{0,3}}
      | 0[1-9]\d{{8,10}}
    )(?!(?!x\d)\w|[.,-]\d))
  | (?P<cue>(?i:(?<![^\W_])(?:tel|telephone|phone|call|fax|mobile|cell|whatsapp|telefon|handy|mobil|téléphone|portable|teléfono|móvil|телефон|тел)\b[.:]?[ ]{{0,2}}))(?P<number>\(?\d(?:[ ()./-]{{0,2}}\d){{6,14}})(?!\w|[.,-]\d)
  | (?P<card>(?<![\w.+])\d(?:[ -]?\d){{12,18}}(?!\w))
  | (?P<title>\b(?:(?:{_titles})\.?\s+)+)(?=[^\W\d_])
  | (?P<intro>(?i:(?<![^\W_])(?:my[ ]name[ ]is|mein[ ]name[ ]ist|ich[ ]heiße|je[ ]m['’]appelle|mon[ ]nom[ ]est|me[ ]llamo|mi[ ]nombre[ ]es|меня[ ]зовут)[ ])))
    """,
    re.VERBOSE,
)
#: After a word such as "call": a number of another kind, or a date.
NO_PHONE = re.compile(r"\d{3}-\d{2}-\d{4}$|\d+(?:\.\d+){3}$|(?:19|20)\d\d-\d\d-\d\d|\d\d?([./-])\d\d?\1(?:19|20)\d\d(?!\d)")
#: What every entity but a person has some of, and introductions; most texts have none.
TRIGGER = re.compile(r"\d(?:\d\d|[ ()./-]{1,3}\d|[0-9a-fA-F]{15}|(?<=[0-9a-fA-F]{15}.))")
SIGNS = ("@", "AKIA", "ASIA", "gh", "sk-", "xox", "г-")
INTROS = ("name is", "name ist", "ich hei", "appelle", "nom est", "llamo", "nombre es", "зовут")
LABELS = ("password", "passwd", "pwd", "secret", "token", "key")
TITLE_WORDS = frozenset(t for ts in TITLES.values() for t in ts)

Entity = tuple[int, int, str, str]  # begin, end, kind, canonical form


# ------------------------------------------------------------------ detection
def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def card_like(digits: str) -> bool:
    """Luhn-valid with an issuer's first digit; other long numbers are no cards."""
    return digits[0] in "23456" and luhn(digits)


def iban_check(compact: str) -> int:
    moved = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def digits_of(s: str) -> str:
    return re.sub(r"\D", "", s)


def script_of(name: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", name) else "latin"


def gender_of(given: str) -> str:
    return GENDERS.get(given) or GENDERS.get(given.capitalize(), "")


def entities(text: str) -> list[Entity]:
    """Entities from left to right, without overlaps."""
    if not text:
        return []
    words = NAME.findall(text)
    out = marked(text) if may_be_marked(text, words) else []
    if BEGINS.isdisjoint(words) and not any(kind.startswith(("given", "family")) for _, _, kind, _ in out):
        return out
    return with_mentions(text, with_untitled(text, out))


def may_be_marked(text: str, words: list[str]) -> bool:
    if TRIGGER.search(text) or any(x in text for x in SIGNS) or not TITLE_WORDS.isdisjoint(words):
        return True
    low = text.lower()
    return any(x in low for x in INTROS) or any(x in low for x in LABELS) and ("=" in low or ":" in low)


def free(found: list[Entity], spans: Iterator[re.Match]) -> Iterator[re.Match]:
    """Matches, from left to right, that overlap none of the entities."""
    k = 0
    for m in spans:
        while k < len(found) and found[k][1] <= m.start():
            k += 1
        if k == len(found) or m.end() <= found[k][0]:
            yield m


def with_untitled(text: str, found: list[Entity]) -> list[Entity]:
    """Adds persons that begin with a known given name and have another part."""
    new: list[Entity] = []
    at = 0
    for m in free(found, NAME.finditer(text)):
        if m.start() >= at and m[0] in BEGINS:
            parts = person(text, m.start(), gender_of(m[0]))
            if len({kind[:5] for _, _, kind, _ in parts}) > 1:  # given and family
                new += parts
            at = parts[-1][1] if parts else at
    old = {(a, b) for a, b, *_ in found}
    new = [e for e in new if (e[0], e[1]) not in old]
    return sorted(found + new) if new else found


def with_mentions(text: str, found: list[Entity]) -> list[Entity]:
    """Adds the other capitalised mentions of the document's names, each name of one kind."""
    names: dict[str, str] = {}
    for _, _, kind, canonical in found:
        if kind.startswith(("given", "family")) and (canonical not in names or kind.startswith("given") > names[canonical].startswith("given")):
            names[canonical] = kind
    found = [(a, b, names[c] if kind.startswith(("given", "family")) else kind, c) for a, b, kind, c in found]
    more = [(*m.span(), names[m[0].lower()], m[0].lower()) for m in free(found, NAME.finditer(text)) if m[0].lower() in names and m[0] not in NO_NAME and len(m[0]) > 1]
    return sorted(found + more) if more else found


def marked(text: str) -> list[Entity]:
    """Entities told by their format, a title or an introduction."""
    out: list[Entity] = []
    at = 0
    while m := PATTERN.search(text, at):
        found = []
        a, b = m.span()
        if m["email"]:
            found = [(a, b, "email", m["email"].lower())]
        elif m["iban"]:
            compact = m["iban"].replace(" ", "")
            if iban_check(compact) == 1:
                found = [(a, b, "iban", compact)]
        elif m["key"]:
            found = [(a, b, "key", m["key"])]
        elif m["secret"]:
            found = [(a, b, "secret", m["secret"])]
        elif m["label"]:
            if re.search(r"\d", m["value"]):
                found = [(m.start("value"), b, "secret", m["value"])]
        elif m["ip"]:
            found = [(a, b, "ip", m["ip"])]
        elif m["ssn"] or m["phone"]:
            kind = "ssn" if m["ssn"] else "phone"
            if kind == "ssn" or 7 <= len(digits_of(m[0])) <= 15:
                found = [(a, b, kind, ("+" if m[0][0] == "+" else "") + digits_of(m[0]))]
                if kind == "phone" and m[0].startswith("00"):
                    found = [(a, b, kind, "+" + digits_of(m[0])[2:])]
        elif m["cue"]:
            if not NO_PHONE.match(m["number"]):
                digits = digits_of(m["number"])
                found = [(m.start("number"), b, "phone", "+" + digits[2:] if digits.startswith("00") else digits)]
        elif m["card"]:
            if card_like(digits_of(m["card"])):
                found = [(a, b, "card", digits_of(m["card"]))]
        else:
            titles = re.findall(r"[^\s.]+", m["title"] or "")
            genders = [g for t in titles for g, ts in TITLES.items() if t in ts and g != "n"]
            found = person(text, b, genders[0] if genders else "n")
        out += found
        at = found[-1][1] if found else b if m["title"] else a + 1
    return out


def person(text: str, at: int, gender: str) -> list[Entity]:
    """The parts of the name that begins here: given names, and the family name last."""
    parts = []
    m = FIRST.match(text, at)
    while m and m[1] not in NO_NAME and (len(m[1]) > 1 or text[m.end() : m.end() + 1] != "."):  # initials stay
        parts.append(m)
        m = NEXT.match(text, m.end())
    out = []
    last = True  # what hyphens join to the last part belongs to the family name
    for x in reversed(parts):
        kind = f"family::{script_of(x[1])}" if last else f"given:{gender_of(x[1]) or gender}:{script_of(x[1])}"
        out.append((*x.span(1), kind, x[1].lower()))
        last = last and x[0][0] == "-"
    return out[::-1]


# ------------------------------------------------------------------ surrogates
class Stream:
    """Keyed pseudo-random numbers for one entity and attempt."""

    def __init__(self, key: str, kind: str, canonical: str, attempt: int):
        self.seed = "\x1f".join((kind, canonical, str(attempt)))
        self.key, self.block, self.held = key.encode(), 0, b""

    def below(self, n: int) -> int:
        while len(self.held) < 6:
            self.held += hmac.digest(self.key, f"{self.seed}\x1f{self.block}".encode(), "sha256")
            self.block += 1
        v, self.held = int.from_bytes(self.held[:6], "big"), self.held[6:]
        return v % n

    def choice(self, items):
        return items[self.below(len(items))]

    def like(self, s: str) -> str:
        """The same character classes: digits, letters by case; the rest stays."""
        out = []
        for c in s:
            if c.isdigit():
                out.append(self.choice("0123456789"))
            elif "a" <= c.lower() <= "z":
                x = self.choice("abcdefghijklmnopqrstuvwxyz")
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)

    def like_hex(self, s: str) -> str:
        return "".join(self.choice("0123456789abcdef") for _ in s)


def surrogate(key: str, kind: str, canonical: str, attempt: int) -> str:
    """The surrogate of a canonical form, in canonical form; of an email the domain stays, which has its own."""
    r = Stream(key, kind, canonical, attempt)
    more = max(0, attempt - WIDER + 2) // 2
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        return f"{r.like(local + 'a' * more)}@{domain}"
    if kind == "domain":
        labels, fixed = domain_parts(canonical)
        return ".".join([r.like(x + "a" * more * (k == 0)) for k, x in enumerate(labels)] + fixed)
    if kind == "ip":
        octets = canonical.split(".")
        fixed = 1 if octets[0] in ("10", "127") else 2 if octets[0] in ("192", "172") and octets[1] in ("168", *map(str, range(16, 32))) else 0
        ranges = {1: (1, 10), 2: (10, 100), 3: (100, 224)}
        if more > 4:  # even the four octets are crowded: a unique local address
            return "fd" + ":".join(r.like_hex("00" if k == 0 else "0000") for k in range(8))
        if more:  # octets of any length, and at last the largest private range
            out = ["10"] if fixed and more > 2 else octets[:fixed]
            return ".".join(out + [str(1 + r.below(254)) if k or out else first_octet(r, 1, 224) for k in range(4 - len(out))])
        out = octets[:fixed]
        for k, o in enumerate(octets[fixed:]):
            low, high = ranges[len(o)]
            out.append(str(low + r.below(high - low)) if k or fixed else first_octet(r, low, high))
        return ".".join(out)
    if kind == "ssn":
        return f"9{r.like(canonical[1:] + '0' * more)}"
    if kind == "phone":
        plus, digits = ("+", canonical[1:]) if canonical[0] == "+" else ("", canonical)
        country = 1 if plus and digits[0] in "17" else 2 if plus else len(digits) - len(digits.lstrip("0"))  # or the trunk's zero
        if not plus and len(digits) == 11 and digits[0] == "1":
            country = 1
        return plus + digits[:country] + r.choice("23456789") + r.like(digits[country + 1 :] + "0" * more)
    if kind == "card":
        body = canonical[0] + r.like(canonical[1:-1] + "0" * more)
        ends = [d for d in "0123456789" if luhn(body + d) == luhn(canonical)]
        return body + r.choice(ends)
    if kind == "iban":
        body = r.like(canonical[4:] + "0" * more)
        check = 98 - iban_check(canonical[:2] + "00" + body)
        return f"{canonical[:2]}{check:02d}{body}"
    if kind in ("key", "secret"):
        prefix = re.match(r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[baprs]-)?", canonical)[0]
        rest = canonical[len(prefix) :]
        if not prefix and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", rest):
            value = r.like_hex(rest + "0" * more)
            return value if rest.lower() == rest else value.upper()
        return prefix + r.like(rest + "0" * more)
    part, gender, script = kind.split(":")
    names = FAMILY[script] if part == "family" else GIVEN[script][gender or "n"]
    if attempt < 3:
        return r.choice(names).lower()
    return "".join(r.choice(SYLLABLES[script]) for _ in range(2 + attempt // 8)) + ENDINGS[script][gender if part == "given" else ""]


def first_octet(r: Stream, low: int, high: int) -> str:
    while (v := low + r.below(high - low)) in (10, 127, 172, 192):
        pass
    return str(v)


def domain_parts(domain: str) -> tuple[list[str], list[str]]:
    """The labels that a surrogate replaces, and those that stay: the top level, and ``example`` before it."""
    labels = domain.split(".")
    keep = 2 if labels[-2] == "example" else 1
    return labels[: len(labels) - keep], labels[len(labels) - keep :]


def rendered(kind: str, value: str, mention: str) -> str:
    """A surrogate in the layout and capitals of the mention."""
    if kind in ("phone", "ssn", "card", "iban"):
        chars = iter(("00" if kind == "phone" and value[0] == "+" and mention.startswith("00") else "") + value.lstrip("+"))
        return "".join(next(chars) if c.isalnum() else c for c in mention) + "".join(chars)
    if kind == "email":
        if mention.isupper():
            return value.upper()
        sides = zip(value.rsplit("@", 1), mention.rsplit("@", 1), strict=True)
        return "@".join("".join(v.upper() if c.isupper() else v for v, c in zip(new, old.ljust(len(new)), strict=True)) for new, old in sides)
    if kind in ("key", "secret", "ip"):
        return value
    if len(mention) > 1 and mention.isupper():
        return value.upper()
    return value.capitalize()


def replaced(text: str, found: list[Entity], value: Callable[[str, str], str]) -> str:
    out, at = [], 0
    for a, b, kind, canonical in found:
        out += [text[at:a], rendered(kind, value(kind, canonical), text[a:b])]
        at = b
    out.append(text[at:])
    return "".join(out)


# ------------------------------------------------------------------ the corpus
def judged(text: str) -> set[tuple[str, str]]:
    """(kind, canonical) of all that needs a surrogate of its own: the entities, and the domains of emails."""
    found = {(kind, c) for _, _, kind, c in entities(text)}
    return found | {("domain", c.rsplit("@", 1)[1]) for kind, c in found if kind == "email"}


def distinct_entities(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set().union(*(judged(t.as_py() or "") for t in batch.column(0)))
            kinds, forms = zip(*seen, strict=True) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(forms, pa.string())], names=["kind", "canonical"])

    return texts.mapInArrow(run, "kind string, canonical string").distinct()


def attempts(found: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, attempt, surrogate) without collisions; ``found`` is a stored table.

    Each attempt is judged once. Of those that propose one surrogate the first by
    (canonical, kind) has it, a minimum that each task takes of its own rows before
    they are shuffled, so a name that very many propose is no hot key; whom it
    left out is told by entity. A surrogate given in an earlier attempt is taken.
    Domains that stay as they are take no part, but no other becomes one of them.
    """

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for x in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True) if x[0] != "domain" or domain_parts(x[1])[0]]
            kinds, forms, tries = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(kinds, pa.string()), pa.array(forms, pa.string()), pa.array(tries, pa.int32()), pa.array([surrogate(key, *x) for x in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "canonical", "attempt", "surrogate"])

    schema = "kind string, canonical string, attempt int, surrogate string"
    columns, entity, value = ["kind", "canonical", "attempt", "surrogate"], ["kind", "canonical"], ["space", "surrogate"]
    # given names of every gender share one set of surrogates
    space = F.regexp_extract("kind", "^[a-z]+", 0)
    real = found.select(space.alias("space"), F.col("canonical").alias("surrogate")).distinct()
    taken = None
    tried = found.withColumn("attempt", F.lit(0))
    while True:
        tried = stored(tried.select(*entity, "attempt").mapInArrow(propose, schema), "proposed")
        first = tried.withColumn("space", space).groupBy(*value).agg(F.min(F.struct("canonical", "kind", "attempt")).alias("first"))
        won = first.join(real, value, "left_anti").select(*value, "first.*").select(*columns)
        if taken is not None:
            won = won.withColumn("space", space).join(taken.withColumn("space", space), value, "left_anti").select(*columns)
        won = stored(won, "surrogates")
        taken = won if taken is None else taken.unionByName(won)
        lost = tried.join(won, entity, "left_anti")
        if lost.isEmpty():
            return taken
        tried = lost.withColumn("attempt", F.col("attempt") + 1)


def replace_pii(docs: DataFrame, key: str = DEMO_KEY, text_col: str = "text", sent: int = SENT) -> DataFrame:
    """``docs`` with entities of the text column replaced and ``n_replaced`` added.

    Surrogates are a function of the entity and its attempt, so only entities
    that collided are looked up. Up to ``sent`` of those go to the tasks; more
    are joined to the rows that mention them.
    """
    found = stored(distinct_entities(pick(docs, text=text_col)), "entities")
    later = attempts(found, key).where("attempt > 0").select("kind", "canonical", "attempt")
    columns = [c for c in docs.columns if c != "n_replaced"]
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    few = later.limit(sent + 1).count() <= sent
    schema = T.StructType([*docs.schema.fields, T.StructField("n_replaced", T.IntegerType())])
    if few:
        tries = {(r["kind"], r["canonical"]): r["attempt"] for r in later.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(tries)
        return docs.mapInArrow(replacing(key, columns.index(text_col), lambda _: shared.value, columns), schema)

    rows = stored(docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*docs.columns).alias("__doc")), "rows")

    def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r, kind, c) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for kind, c in judged(t or "")]
            ids, kinds, forms = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], names=["__row", "kind", "canonical"])

    mentioned = rows.select("__row", F.col(f"__doc.`{text_col}`")).mapInArrow(mentions, "__row long, kind string, canonical string").distinct()
    per_row = stored(mentioned, "mentions").join(later, ["kind", "canonical"]).groupBy("__row").agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("__tries"))
    joined = rows.join(per_row, "__row", "left").select("__doc.*", "__tries")
    own = lambda r: {(x["kind"], x["canonical"]): x["attempt"] for x in r or ()}
    return joined.mapInArrow(replacing(key, columns.index(text_col), own, columns), schema)


def replacing(key: str, at: int, tries_of: Callable, columns: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str, int], str] = {}

        def known_value(kind: str, canonical: str, tries: dict[tuple[str, str], int]) -> str:
            if len(known) > 100_000:
                known.clear()
            k = (kind, canonical, tries.get((kind, canonical), 0))
            if k not in known:
                known[k] = surrogate(key, *k)
            return known[k]

        def value(kind: str, canonical: str, tries: dict[tuple[str, str], int]) -> str:
            new = known_value(kind, canonical, tries)
            if kind != "email":
                return new
            local, domain = new.rsplit("@", 1)
            return f"{local}@{known_value('domain', domain, tries)}"

        for batch in batches:
            own = batch.column(len(columns)).to_pylist() if batch.num_columns > len(columns) else [None] * batch.num_rows
            texts, counts = [], []
            for t, r in zip(batch.column(at), own, strict=True):
                text = t.as_py()
                found = entities(text or "")
                if found:
                    tries = tries_of(r)
                    text = replaced(text, found, lambda kind, c: value(kind, c, tries))  # noqa: B023
                texts.append(text)
                counts.append(len(found))
            arrays = list(batch.columns[: len(columns)])
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int32())], names=[*columns, "n_replaced"])

    return run


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

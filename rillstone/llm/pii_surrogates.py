"""PII: keyed, type-consistent surrogates for detected entities.

Entities (e-mail and IP addresses, telephone, card, account and identity numbers, credentials, persons
named with a title) are found by one pattern. Each is replaced by a surrogate drawn from a keyed hash of
its canonical form: an address in lower case, a telephone number with its country code, a credential's
value without its name. So all mentions of an entity have one surrogate, whatever their format. A
surrogate keeps the format of its mention: separators, the cases of letters, a country code, a card's
first digit and check sum, a private address's range, a person's title, gender and script.

Names are words with hyphens and apostrophes too, and may have initials before or between them.
A person's given and family names are entities of their own: `Mr. John Smith`, `Mr. Smith`, `Dr. John
Smith` and, in the same document, `John Smith` or `Smith` without title have the same names afterwards.
The gender of a given name is that of its title, else that of most titles it has in the corpus, else its
ending's.

Distinct entities get distinct surrogates, which are no entity of the corpus either: surrogates that
collide are drawn again, by another number in the hash, until none does. Every LONGER draws they get
longer, so that they do not run out.

The texts are searched once: mentions and their kinds are marked, and all that follows reads the marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, written

KEY = "surrogates-1"
#: Draws after which a surrogate is longer than its entity by one more character or syllable.
LONGER = 16
#: What marks mentions in texts, none a character of any script, and what stands for them if a text has one.
OPEN, NEXT, ESCAPE = "\uFFFE", "\uFFFF", "\uFDD2"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES_M, _TITLES_F, _TITLES_N = r"Mr|Herr|Monsieur|Señor|Sir|Г-н", r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Lady|Г-жа", r"Dr|Prof"
_H = "[0-9A-Fa-f]{1,4}"
#: A word of a name: also one with hyphens or apostrophes.
_NAME = r"\p{Lu}(?:\p{L}+|['’]\p{Lu}\p{L}+)(?:[-'’]\p{Lu}\p{L}+)*"
#: Kinds and their patterns, in the order in which they are tried; none has a group of its own.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "credential": r"""(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|(?:[Pp]assword|[Pp]asswd|pwd|[Ss]ecret|[Tt]oken|[Aa]pi_?[Kk]ey) ?[=:] ?["']?[A-Za-z0-9_+/=-]{8,})""",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "ip6": rf"(?<![\w:.])(?:{_H}(?::{_H}){{7}}|(?:2[0-9A-Fa-f]{{3}}|[fF][cdeCDE][0-9A-Fa-f]{{2}})(?::{_H}){{0,5}}::(?:{_H}(?::{_H}){{0,5}})?)(?![\w:])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "identity": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "account": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "person": rf"(?<![\w-])(?:{_TITLES_M}|{_TITLES_F}|{_TITLES_N})\.? (?:(?:\p{{Lu}}\. ){{1,3}})?{_NAME}(?:(?: \p{{Lu}}\.){{0,3}} {_NAME})?",
}
KINDS = tuple(PATTERNS)
PATTERN = "|".join(f"({p})" for p in PATTERNS.values())
#: Calling codes of countries by their length.
CALLING_CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: A number without a country code is one of this country.
HOME_CODE = "1"
#: First numbers of public addresses.
PUBLIC = [n for n in range(1, 224) if n not in (10, 100, 127, 169, 172, 192, 198, 203)]

#: Given names by script and gender, syllables of family names.
NAMES = {
    ("latin", "f"): ["Ada", "Clara", "Edith", "Flora", "Greta", "Helen", "Ines", "Julia", "Karin", "Laura", "Marta", "Nora", "Olga", "Paula", "Rosa", "Vera"],
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Louis", "Martin", "Oscar", "Paul", "Robert", "Simon"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Зоя", "Инна", "Мария", "Нина"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Егор", "Иван", "Олег", "Павел"],
}
SYLLABLES = {"latin": ["ba", "den", "fal", "gor", "hin", "ker", "lam", "mor", "nis", "pel", "ran", "sto", "tam", "ul", "ver", "wil"], "cyrillic": ["бар", "вел", "гор", "дан", "кор", "лам", "мир", "нев", "пет", "рад", "сок", "тим", "фад", "хар", "шум", "юр"]}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _number(entity: Column) -> Column:
    """A telephone number's digits with its country code."""
    digits = _digits(entity)
    return F.when(F.startswith(entity, F.lit("+")) | (F.length(digits) != 10), digits).otherwise(F.concat(F.lit(HOME_CODE), digits))


def canonical(kind: Column, entity: Column) -> Column:
    """The same for all mentions of one entity; of a name (kinds given.* and family.*) its lower case."""
    digits = _digits(entity)
    value = F.regexp_replace(entity, r"""^\w+ ?[=:] ?["']?""", "")
    name = F.regexp_replace(F.lower(entity), "(ов|ев|ин)а$", "$1")
    out = F.when(kind == "phone", _number(entity)).when(kind.isin("identity", "card"), digits).when(kind == "account", F.replace(entity, F.lit(" "), F.lit("")))
    out = out.when(kind == "email", F.lower(entity)).when(kind == "credential", value).when(kind == "ip6", F.regexp_replace(F.lower(entity), "(^|:)0+(?=[0-9a-f])", "$1"))
    return out.when(F.startswith(kind, F.lit("family")), name).when(F.startswith(kind, F.lit("given")), F.lower(entity)).otherwise(entity)


def _draws(seed: Column, attempt: Column, key: str) -> Column:
    """Function of a place: a number below 65,536."""
    base = F.concat(F.lit(key), F.lit("|"), attempt.cast("string"), F.lit("|"), seed)
    return F.concat(F.sha2(base, 256), F.sha2(F.concat(F.lit("more|"), base), 256))


def _draw(draws: Column, i: Column) -> Column:
    return F.conv(F.substr(draws, (F.pmod(i, F.lit(32)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is(c: Column, a: str, z: str) -> Column:
    return (c >= a) & (c <= z)


def _scrambled(text: Column, draws: Column, letters: Column) -> Column:
    """text with other digits and letters (of the first so many of the alphabet), each of its class."""
    char = lambda i: F.substr(text, (i + 1).cast("int"), F.lit(1))
    other = lambda c, v: F.when(_is(c, "0", "9"), F.char(48 + v % 10)).when(_is(c, "a", "z"), F.char(97 + v % letters)).when(_is(c, "A", "Z"), F.char(65 + v % letters)).otherwise(c)
    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.length(text) - 1), lambda i: other(char(i), _draw(draws, i))), "")).otherwise("")


def _more(draws: Column, attempt: Column, letters: str = "0123456789") -> Column:
    """Characters by which a surrogate is longer after so many draws."""
    n = F.floor(attempt / LONGER).cast("int")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(F.lit(letters), _draw(draws, 31 - i) % len(letters) + 1, F.lit(1))), "")).otherwise("")


def _refilled(text: Column, digits: Column) -> Column:
    """text with its digits replaced by those of digits, in turn; what is left of them follows."""
    place = lambda i: F.length(_digits(F.substr(text, F.lit(1), i)))
    at = lambda i: F.substr(text, i, F.lit(1))
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.when(_is(at(i), "0", "9"), F.substr(digits, place(i), F.lit(1))).otherwise(at(i))), "")
    return F.concat(own, F.substr(digits, F.length(_digits(text)) + 1, F.length(digits)))


def _check_digit(digits: Column) -> Column:
    """The digit that makes the Luhn sum of digits and itself a multiple of ten."""
    n = F.length(digits)
    double = lambda i: F.substr(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + double(i) - F.when(double(i) > 9, 9).otherwise(0))
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def name_kinds(part: str, script: Column, gender: Column | None = None) -> Column:
    return F.concat_ws(".", F.lit(part), script, *([gender] if gender is not None else []))


def _cased(name: Column, like: Column) -> Column:
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(name)).otherwise(name)


def _name(kind: Column, entity: Column, draws: Column, attempt: Column) -> Column:
    """A given name of the kind's script and gender, or a family name of its script; more draws make them longer."""

    def drawn(words: list[str], last: Column, between: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.get(F.array(*map(F.lit, words)), _draw(draws, i) % len(words))), between)

    out = F.lit("")
    for (script, gender), names in NAMES.items():
        out = F.when(kind == f"given.{script}.{gender}", drawn(names, attempt, "-")).otherwise(out)
    for script, words in SYLLABLES.items():
        body = drawn(words, 2 + F.floor(attempt / 2), "")
        ending = F.when(entity.rlike("(ов|ев|ин)а$"), "ова").otherwise("ов") if script == "cyrillic" else F.lit("")
        out = F.when(kind == f"family.{script}", F.concat(F.initcap(body), ending)).otherwise(out)
    return _cased(out, entity)


def _drawn_for(kind: Column, entity: Column, attempt: Column, key: str, make) -> Column:
    return _let(_draws(F.concat(kind, F.lit("|"), canonical(kind, entity)), attempt, key), make)


def name_surrogate(kind: Column, name: Column, attempt: Column, key: str = KEY) -> Column:
    """The replacement of a given or family name."""
    return _drawn_for(kind, name, attempt, key, lambda draws: _name(kind, name, draws, attempt))


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """The replacement of a mention."""
    other = lambda x, draws, letters=26: _scrambled(x, draws, letters if isinstance(letters, Column) else F.lit(letters))

    def phone(draws: Column) -> Column:
        def changed(canon: Column) -> Column:
            code = F.regexp_extract(canon, CALLING_CODE, 1)
            new = F.concat(code, _let(F.substr(canon, F.length(code) + 1, F.length(canon)), lambda x: other(x, draws)), _more(draws, attempt))
            return F.substr(new, F.length(canon) - F.length(_digits(entity)) + 1, F.length(new))  # without what the mention leaves out

        return _let(_let(_number(entity), changed), lambda d: _refilled(entity, d))

    def identity(draws: Column) -> Column:
        return _let(F.concat(_let(_digits(entity), lambda d: other(d, draws)), _more(draws, attempt)), lambda d: _refilled(entity, d))

    def card(draws: Column) -> Column:
        body = _let(_digits(entity), lambda d: F.concat(F.substr(d, F.lit(1), F.lit(1)), F.substr(other(d, draws), F.lit(2), F.length(d) - 2)))
        whole = lambda b: F.concat(b, _check_digit(b))
        return _let(_let(F.concat(body, _more(draws, attempt)), whole), lambda d: _refilled(entity, d))

    def email(draws: Column) -> Column:
        local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
        end = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
        name = F.substr(domain, F.lit(1), F.length(domain) - F.length(end))
        return F.concat(other(local, draws), _more(draws, attempt), F.lit("@"), _let(_draws(F.lower(domain), F.lit(0), key), lambda d: other(name, d)), end)

    def credential(draws: Column) -> Column:
        prefix = F.regexp_extract(entity, r"""^(AKIA|gh[pousr]_|sk-|\w+ ?[=:] ?["']?)""", 1)
        value = F.substr(entity, F.length(prefix) + 1, F.length(entity))
        return F.concat(prefix, other(value, draws, F.when(value.rlike("^[0-9a-f]+$"), 6).otherwise(26)), _more(draws, attempt))

    def ip(draws: Column) -> Column:
        octet = lambda i: (1 + _draw(draws, F.lit(i)) % 254).cast("string")
        first = F.get(F.array(*map(F.lit, PUBLIC)), _draw(draws, F.lit(0)) % len(PUBLIC)).cast("string")
        public = F.concat_ws(".", first, octet(1), octet(2), octet(3))
        ten = F.concat_ws(".", F.lit("10"), octet(1), octet(2), octet(3))
        kept = F.when(entity.rlike(r"^(?:10|127)\."), F.concat_ws(".", F.substring_index(entity, ".", 1), octet(1), octet(2), octet(3)))
        kept = kept.when(entity.rlike(r"^(?:192\.168|169\.254)\."), F.concat_ws(".", F.substring_index(entity, ".", 2), octet(2), octet(3)))
        kept = kept.when(entity.rlike(r"^172\.(?:1[6-9]|2\d|3[01])\."), F.concat_ws(".", F.lit("172"), (16 + _draw(draws, F.lit(1)) % 16).cast("string"), octet(2), octet(3)))
        wider = F.when(attempt < LONGER, kept).when(attempt < 3 * LONGER, ten)  # a small range may be full
        return F.when(kept.isNotNull() & wider.isNotNull(), wider).otherwise(public)

    def ip6(draws: Column) -> Column:
        head = F.regexp_extract(entity, "^[0-9A-Fa-f]+", 0)
        rest = F.substr(entity, F.length(head) + 1, F.length(entity))
        char = lambda i: F.substr(rest, i, F.lit(1))
        hexed = lambda i: F.substr(F.lit("123456789abcdef"), _draw(draws, i) % 15 + 1, F.lit(1))
        new = F.array_join(F.transform(F.sequence(F.lit(1), F.length(rest)), lambda i: F.when(char(i) == ":", ":").otherwise(hexed(i))), "")
        return F.concat(head, new, F.when(F.contains(rest, F.lit("::")), F.when(attempt >= 4, F.concat(F.when(F.endswith(rest, F.lit(":")), "").otherwise(":"), F.substr(draws, attempt % 100 + 1, F.lit(4)))).otherwise("")).otherwise(""))

    def account(draws: Column) -> Column:
        plain = F.replace(entity, F.lit(" "), F.lit(""))
        new = F.concat(F.substr(plain, F.lit(1), F.lit(2)), F.substr(other(plain, draws), F.lit(3), F.length(plain)))
        spaced = lambda o: F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), lambda i: F.when(F.substr(entity, i, F.lit(1)) == " ", " ").otherwise(F.substr(o, F.length(F.replace(F.substr(entity, F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1)))), "")
        return F.concat(_let(new, spaced), _more(draws, attempt))

    kinds = (("email", email), ("credential", credential), ("ip", ip), ("ip6", ip6), ("phone", phone), ("identity", identity), ("card", card), ("account", account))

    def choose(draws: Column) -> Column:
        out = entity
        for name, make in kinds:
            out = F.when(kind == name, make(draws)).otherwise(out)
        return out

    return _drawn_for(kind, entity, attempt, key, choose)


def _marked(text: Column) -> Column:
    """text with every mention marked: OPEN, then its text in the place of its kind, each place closed by NEXT."""
    odd = text.rlike(f"[{OPEN}{NEXT}{ESCAPE}]")
    escaped = F.replace(F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "!")), F.lit(OPEN), F.lit(ESCAPE + "#")), F.lit(NEXT), F.lit(ESCAPE + "%"))
    return F.regexp_replace(F.when(odd, escaped).otherwise(text), PATTERN, OPEN + "".join(f"${i + 1}{NEXT}" for i in range(len(KINDS))))


def _unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(F.replace(text, F.lit(ESCAPE + "%"), F.lit(NEXT)), F.lit(ESCAPE + "#"), F.lit(OPEN)), F.lit(ESCAPE + "!"), F.lit(ESCAPE))
    return F.when(F.contains(text, F.lit(ESCAPE)), plain).otherwise(text)


def _mentions(marked: Column) -> Column:
    """Of a marked text: array of structs kind, entity, rest (the text that follows); a person also title, given, family, script."""

    def one(part: Column) -> Column:
        def fields(x: Column) -> Column:
            at = lambda i: F.get(x, F.lit(i))
            kind = F.lit(None).cast("string")
            for i, name in reversed(list(enumerate(KINDS))):
                kind = F.when(at(i) != "", name).otherwise(kind)
            entity = F.concat(*[at(i) for i in range(len(KINDS))])
            person = at(KINDS.index("person"))
            words = F.split(F.regexp_replace(person, r"^\S+ ", ""), " ")
            names = F.filter(words, lambda w: ~F.endswith(w, F.lit(".")))
            return F.struct(
                kind.alias("kind"), entity.alias("entity"), at(len(KINDS)).alias("rest"), F.regexp_extract(person, r"^(\S+ )", 1).alias("title"), F.when(F.size(names) > 1, F.get(names, F.lit(0))).alias("given"),
                F.when(person != "", F.element_at(names, -1)).alias("family"), F.when(person.rlike(r"\p{IsCyrillic}{2}"), "cyrillic").otherwise("latin").alias("script"),
                F.transform(words, lambda w: F.endswith(w, F.lit("."))).alias("initials"),
            )

        return _let(F.split(part, NEXT, -1), fields)

    parts = F.split(marked, OPEN, -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), one)


def _titled(title: Column) -> Column:
    return F.when(title.rlike(rf"^(?:{_TITLES_F})\b"), "f").when(title.rlike(rf"^(?:{_TITLES_M})\b"), "m")


def _put(x: Column, given: Column, family: Column) -> Column:
    """A person's mention with other names; an initial becomes that of the other given name, or of the family name if there is none."""

    def of(names: Column) -> Column:
        initial = F.concat(F.substr(F.get(names, F.lit(0)), F.lit(1), F.lit(1)), F.lit("."))
        word = lambda is_initial, i: F.when(is_initial, initial).when(i == F.size(x["initials"]) - 1, F.element_at(names, -1)).otherwise(F.get(names, F.lit(0)))
        return F.concat(x["title"], F.array_join(F.transform(x["initials"], word), " "))

    return _let(F.when(x["given"].isNotNull(), F.array(given, family)).otherwise(F.array(family)), of)


def _note(kind: Column, canon: Column) -> Column:
    return F.concat_ws("|", kind, canon)


def _gender(m: Column, notes: Column) -> Column:
    """Of a person's given name: by title, by the corpus (a note: 1 m, 2 f), by ending."""
    said = F.try_element_at(notes, _note(name_kinds("gender", m["script"]), F.lower(m["given"])))
    return F.coalesce(_titled(m["title"]), F.when(said == 1, "m").when(said == 2, "f"), F.when(m["given"].rlike("[aаяe]$"), "f").otherwise("m"))


def attempts(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, canon, attempt of the entities (kind, canon, entity: one mention) whose first surrogate collides.

    Each round draws anew only for those that collide with another's surrogate or with an entity.
    """

    def drawn(rows: DataFrame) -> DataFrame:
        kind, entity, attempt = F.col("kind"), F.col("entity"), F.col("attempt")
        new = F.when(F.contains(kind, F.lit(".")), name_surrogate(kind, entity, attempt, key)).otherwise(surrogate(kind, entity, attempt, key))
        return rows.withColumn("to", _let(new, lambda x: canonical(kind, x)))

    def split(rows: DataFrame, others: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
        """rows whose surrogate nothing else has, and the others."""
        few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        mine = rows.select("kind", "to").distinct()
        mine = F.broadcast(mine) if few else mine
        taken = None
        for other in others:
            hit = other.join(mine, ["kind", "to"], "left_semi").distinct()
            taken = hit if taken is None else taken.unionByName(hit)
        taken = taken.distinct().withColumn("taken", F.lit(True))
        first = rows.groupBy("kind", "to").agg(F.min("canon").alias("first"))
        marked = rows.join(first, ["kind", "to"]).join(taken, ["kind", "to"], "left")
        marked = written(marked.withColumn("again", F.col("taken").isNotNull() | (F.col("first") != F.col("canon"))).drop("first", "taken"), "marked")
        return marked.filter("NOT again"), marked.filter("again").select("kind", "canon", "entity", "attempt")

    rows = written(drawn(entities.withColumn("attempt", F.lit(0))), "drawn")
    known = rows.select("kind", F.col("canon").alias("to"))
    settled, again = split(rows, [known])
    taken, found = [known, settled.select("kind", "to")], None
    while not again.isEmpty():
        rows = written(drawn(again.withColumn("attempt", F.col("attempt") + 1)), "drawn")
        settled, again = split(rows, taken)
        taken.append(settled.select("kind", "to"))
        part = settled.select("kind", "canon", "attempt")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else settled.select("kind", "canon", "attempt").limit(0)


def replace(documents: DataFrame, key: str = KEY) -> DataFrame:
    """documents (doc_id, text and any other columns) with surrogates in text, and n_entities.

    A null text stays null and has no entity. Repeated rows are all returned, with the same
    surrogates; an empty table gives an empty result; a very long text is one row's array of mentions. A
    column named n_entities is replaced; other columns may have any name. Names without a title are
    replaced, and not counted, in documents that also have them with one.
    """
    docs = documents.drop("n_entities")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = written(docs.select(row, F.monotonically_increasing_id().alias("id"), _marked(F.col("text")).alias("marked")), "marked-texts")
    has = F.contains("marked", F.lit(OPEN))
    found = base.filter(has).select("id", F.explode(_mentions(F.col("marked"))).alias("m"))
    found = written(found.select("id", F.struct("m.kind", "m.entity", "m.title", "m.given", "m.family", "m.script").alias("m")), "mentions")
    m = F.col("m")

    # What the corpus says of the gender of given names.
    votes = found.filter("m.given IS NOT NULL").select(name_kinds("gender", m["script"]).alias("kind"), F.lower("m.given").alias("canon"), _titled(m["title"]).alias("g")).filter("g IS NOT NULL")
    votes = votes.groupBy("kind", "canon").agg(F.when(F.count_if(F.col("g") == "f") > F.count_if(F.col("g") == "m"), 2).otherwise(1).alias("value"))
    neutral = found.filter(F.col("m.given").isNotNull() & _titled(m["title"]).isNull()).select("id", name_kinds("gender", m["script"]).alias("kind"), F.lower("m.given").alias("canon"))
    said = written(neutral.join(votes, ["kind", "canon"]).select("id", _note(F.col("kind"), F.col("canon")).alias("note"), "value").distinct(), "genders")
    genders = _noted(said)
    each = attach(found, genders, ["id"]).withColumn("gender", _gender(m, F.col("notes")))

    # Entities of their own: all mentions but persons, and persons' names.
    given = F.struct(name_kinds("given", m["script"], F.col("gender")).alias("kind"), m["given"].alias("entity"))
    family = F.struct(name_kinds("family", m["script"]).alias("kind"), m["family"].alias("entity"))
    whole = F.struct(m["kind"].alias("kind"), m["entity"].alias("entity"))
    own = F.when(m["kind"] != "person", F.array(whole)).when(m["given"].isNull(), F.array(family)).otherwise(F.array(given, family))
    entities = each.select("id", F.explode(own).alias("e")).select("id", "e.kind", "e.entity", canonical(F.col("e.kind"), F.col("e.entity")).alias("canon"))
    entities = written(entities, "entities")
    again = written(attempts(entities.groupBy("kind", "canon").agg(F.min("entity").alias("entity")), key), "again")
    redrawn = attach(entities.select("id", "kind", "canon").distinct(), again, ["kind", "canon"], "inner").select("id", _note(F.col("kind"), F.col("canon")).alias("note"), F.col("attempt").alias("value"))
    notes = written(_noted(said.unionByName(redrawn)), "notes")

    noted = F.col("notes")
    tries = lambda k, e: F.coalesce(F.try_element_at(noted, _note(k, canonical(k, e))), F.lit(0))

    def renaming(kind: Column, name: Column) -> Column:
        return _let(kind, lambda k: _let(tries(k, name), lambda n: name_surrogate(k, name, n, key)))

    def named(x: Column) -> tuple[Column, Column]:
        return renaming(name_kinds("given", x["script"], _gender(x, noted)), x["given"]), renaming(name_kinds("family", x["script"]), x["family"])

    def of(x: Column) -> Column:
        given, family = named(x)
        return F.when(x["kind"] == "person", _put(x, given, family)).otherwise(_let(tries(x["kind"], x["entity"]), lambda n: surrogate(x["kind"], x["entity"], n, key)))

    def bare(x: Column) -> Column:
        given, family = named(x)
        pair = lambda a, b: F.struct(a.alias("name"), b.alias("to"))
        return F.when(x["given"].isNotNull(), F.array(pair(x["family"], family), pair(x["given"], given))).otherwise(F.array(pair(x["family"], family)))

    def renamed(text: Column, names: Column) -> Column:
        """text with whole words that are names replaced; marks stand for them until all are found."""
        holder = lambda i: F.concat(F.lit(OPEN), i.cast("string"), F.lit(NEXT))
        places = F.transform(names, lambda x, i: F.struct(x["name"].alias("name"), x["to"].alias("to"), i.alias("i")))
        held = F.aggregate(places, text, lambda acc, x: F.regexp_replace(acc, F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), x["name"], F.lit(r"(?![\p{L}\p{N}_])")), holder(x["i"])))
        return F.aggregate(places, held, lambda acc, x: F.replace(acc, holder(x["i"]), x["to"]))

    def rewritten(ms: Column) -> Column:
        names = F.array_distinct(F.flatten(F.transform(F.filter(ms, lambda x: x["kind"] == "person"), bare)))
        head = F.substring_index("marked", OPEN, 1)

        def text(names: Column) -> Column:
            left = lambda x: F.when(F.size(names) > 0, renamed(x, names)).otherwise(x)
            return F.concat(left(head), F.array_join(F.transform(ms, lambda x: F.concat(of(x), left(x["rest"]))), ""))

        return F.struct(_unescaped(_let(names, text)).alias("text"), F.size(ms).cast("bigint").alias("n"))

    keyed = attach(base, notes, ["id"]) if not notes.isEmpty() else base.withColumn("notes", F.lit(None).cast("map<string,int>"))
    old = F.struct(F.col("row.text").alias("text"), F.lit(0).cast("bigint").alias("n"))
    out = keyed.select("row", F.when(F.coalesce(has, F.lit(False)), _let(_mentions(F.col("marked")), rewritten)).otherwise(old).alias("new"))
    return out.select(*[F.col("new.text").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns], F.col("new.n").alias("n_entities"))


def _noted(rows: DataFrame) -> DataFrame:
    """id, notes: the notes (id, note, value) of each document as a map."""
    return rows.groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("note", F.col("value").cast("int").alias("value")))).alias("notes"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text and n_entities of every document."""
    return replace(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

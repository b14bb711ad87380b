"""Personal data replaced by surrogates, with DataFrame functions alone.

One pattern finds the entities; a text is cut into the stretches between them
and the entities themselves.  Every distinct entity gets one surrogate: a
keyed hash shaped like the original - digits for digits, letters of the same
script and case, the same separators; card numbers keep their check digit
rule, names the gender and script.  Candidates that meet another entity's
surrogate or any original in the corpus are drawn anew, round by round, until
all differ; so distinct entities stay distinct, and an entity has the same
surrogate wherever it occurs, however it is formatted.  A format that is
short of values is widened by more digits or letters for the entities that
are left, so every corpus has an assignment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import staged, text_or_empty

# ---- fixed values: kinds of entities and their patterns, the first that fits names the kind -----
_TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mademoiselle", "Mlle", "Госпожа")
_TITLES_M = ("Mr", "Herr", "Señor", "Monsieur", "Господин")
_TITLES_N = ("Dr", "Prof")
_GIVEN_F = ("Alice", "Amelia", "Anna", "Carmen", "Catherine", "Charlotte", "Claire", "Elena", "Elizabeth", "Emily",
            "Emma", "Eva", "Hannah", "Heike", "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Julia", "Karen",
            "Laura", "Linda", "Lucía", "Maria", "María", "Marie", "Mary", "Monika", "Olivia", "Patricia", "Sabine",
            "Sarah", "Sophie", "Susan", "Ursula", "Анна", "Елена", "Мария", "Наталья", "Ольга", "Татьяна",
            "Ελένη", "Μαρία", "Σοφία")
_GIVEN_M = ("Alexander", "Andrew", "Antonio", "Carlos", "Charles", "Christopher", "Daniel", "David", "Diego", "Edward",
            "François", "Frank", "George", "Günter", "Hans", "Henry", "Jacques", "James", "Javier", "Jean", "John",
            "José", "Joseph", "Juan", "Jürgen", "Klaus", "Luis", "Michael", "Miguel", "Paul", "Peter", "Philippe",
            "Pierre", "Robert", "Stefan", "Thomas", "William", "Wolfgang", "Александр", "Владимир", "Дмитрий",
            "Иван", "Николай", "Сергей", "Γιώργος", "Δημήτρης", "Νίκος")
_WORD = r"\p{Lu}[\p{L}'’\-]*\p{L}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = r"(?:" + "|".join(_TITLES_F + _TITLES_M + _TITLES_N) + r")\.?"
SECRET_LABEL = r"(?i:password|passwd|pwd|token|secret|api[_\-]?key)(?:\\?[\"'])?\s{0,3}[=:]\s{0,3}(?:\\?[\"'])?"
# What stands before a name and tells it, whatever the name: a field's label, a salutation, the line above a signature.
_FIELD = (r"(?<![\p{L}\p{N}] {0,2})(?:(?:[Ff]ull|[Ff]irst|[Ll]ast|[Ff]amily|[Gg]iven|[Cc]ustomer|[Cc]ontact|[Pp]atient|[Ee]mployee)"
          r"[ _]?)?(?:[Nn]ame|NAME|Nombre|Apellidos?|Nom|Prénom|Vorname|Nachname|Имя|Фамилия|Όνομα|Signed by|Attn|姓名|이름|성명|الاسم"
          r"|שם|नाम)(?:\\?[\"'])?[ \t]{0,3}[:：=][ \t]{0,3}(?:\\?[\"'])?")
_SALUTATION = (r"(?:Dear|Liebe|Lieber|Chère|Cher|Estimada|Estimado|Querida|Querido|Уважаемая|Уважаемый|Дорогая|Дорогой"
               r"|Αγαπητή|Αγαπητέ) (?!(?:Sir|Sirs|Madam|All|Team|Customer|Customers|Friend|Friends|Colleague|Colleagues|Reader"
               r"|Readers|Hiring|Editor|Kolleg|Freund|Collègue|Ami|Client|Cliente|Amig|Коллег|Друг|Друзья)[\p{L}]{0,4}\b)")
_CLOSING = (r"(?:Sincerely(?: yours)?|Yours (?:sincerely|truly|faithfully)|(?:(?:Best|Kind|Warm) )?[Rr]egards|Best wishes|Cheers"
            r"|Mit freundlichen Grüßen|(?:Viele|Beste|Liebe) Grüße|Cordialement|Bien à vous|Atentamente|Un saludo|С уважением"
            r"|Με εκτίμηση),?[ \t]{0,3}\r?\n\s{0,3}")
_CONTEXT = f"(?:{_FIELD}|{_SALUTATION}|{_CLOSING})"
# Scripts without case: words of a few letters.
_PART = r"(?:" + _WORD + r"|\p{Lu}\.)"
_UNCASED = r"(?:[\p{IsHan}]{2,4}|[\p{IsHangul}]{2,4}|[\p{IsHiragana}\p{IsKatakana}\p{IsHan}ー・]{2,12}" + "".join(
    rf"|[\p{{Is{x}}}&&[\p{{L}}\p{{M}}]]{{2,20}}" for x in ("Arabic", "Hebrew", "Devanagari", "Bengali", "Thai", "Georgian")) + ")"
# Each begins with a look at its first character, which fails at once nearly everywhere.
_START, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = (
    ("email", r"(?=[\p{L}\p{N}._%+\-])(?<![\p{L}\p{M}\p{N}._%+\-])[\p{L}\p{M}\p{N}._%+\-]{1,64}+@(?:[\p{L}\p{M}\p{N}\-]{1,63}+\.){1,8}\p{L}{2,24}"),
    ("secret", SECRET_LABEL + r"[^\s\"']{6,}"),
    ("key", r"(?=[Ags])" + _START + r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})" + _END),
    ("hex", r"(?=[0-9A-Fa-f])" + _START + r"(?=[A-Fa-f]*\d)[0-9A-Fa-f]{32,128}+" + _END),
    ("iban", r"(?=[A-Z])" + _START + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END),
    ("ip", r"(?=\d)(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}]|\.\d)"),
    ("ssn", r"(?=\d)(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])"),
    ("card", r"(?=\d)" + _START + r"(?:\d{13,19}+|\d{4}([ \-])\d{4}(?:[ \-]\d{4})[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})" + _END),
    ("phone", r"(?=[+(\d])" + _START + r"(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{1,4}(?:[ .\-]?\d{2,4}){1,5}(?<=" + r"\d[ .()\-]{0,2}" * 6 + r"\d)"
              r"|\(\d{3}\) ?\d{3}[.\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})" + _END),
    ("name", r"(?=\p{Lu})" + _START + "(?:" + _TITLE + r"(?: " + _WORD + r"){1,3}|(?:" + "|".join(_GIVEN_F + _GIVEN_M)
             + r")(?: " + _WORD + r"){1,2})" + _END
             + r"|(?=[\p{Lu}ncflgpe姓이성اשन])" + _START + _CONTEXT + r"(?:" + _TITLE + r" )?(?:" + _WORD + r"(?: " + _PART
             + r"){0,3}|" + _PART + r"(?: " + _PART + r"){0,2} " + _WORD + "|" + _UNCASED + r"(?: " + _UNCASED + r"){0,3})(?![\p{L}\p{M}\p{N}])"),
)
#: Whatever is no name has one of these.
MARKS, MARKED = r"[0-9@=:]", ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-")
#: Alphabets whose letters are replaced within themselves.
ALPHABETS = tuple("".join(map(chr, r)) for r in (
    range(ord("0"), ord("9") + 1), range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1),
    range(ord("а"), ord("я") + 1), range(ord("А"), ord("Я") + 1),
    range(ord("α"), ord("ω") + 1), range(ord("Α"), ord("Ρ") + 1),
    range(0xE0, 0xF7), range(0xF8, 0x100), range(0xC0, 0xD7), range(0xD8, 0xDF),
    range(0x5D0, 0x5EB), range(0x628, 0x63B), range(0x915, 0x93A), range(0x3042, 0x3094), range(0x30A2, 0x30F4),
    range(0xAC00, 0xACC0), range(0x4E00, 0x4EC0)))
#: Every other letter or digit by its class: the first that fits names the letters that replace it.
SCRIPTS = tuple((cls, "".join(chr(x) for r in ranges for x in r)) for cls, *ranges in (
    (r"[\p{IsLatin}&&\p{Lu}]", range(0xC0, 0xD7), range(0xD8, 0xDF)),
    (r"\p{IsLatin}", range(0xE0, 0xF7), range(0xF8, 0x100)),
    (r"[\p{IsCyrillic}&&\p{Lu}]", range(0x410, 0x430)), (r"[\p{IsCyrillic}&&\p{L}]", range(0x430, 0x450)),
    (r"[\p{IsGreek}&&\p{Lu}]", range(0x391, 0x3A2)), (r"[\p{IsGreek}&&\p{L}]", range(0x3B1, 0x3CA)),
    (r"[\p{IsHebrew}&&\p{L}]", range(0x5D0, 0x5EB)),
    (r"[\p{IsArabic}&&\p{L}]", range(0x628, 0x63B), range(0x641, 0x649)),
    (r"[\p{IsDevanagari}&&\p{L}]", range(0x915, 0x93A)), (r"[\p{IsDevanagari}&&\p{M}]", range(0x93E, 0x943)),
    (r"[\p{IsBengali}&&\p{L}]", range(0x995, 0x9A9)), (r"[\p{IsThai}&&\p{L}]", range(0xE01, 0xE2F)),
    (r"[\p{IsThai}&&\p{M}]", range(0xE34, 0xE3A)), (r"[\p{IsArmenian}&&\p{Lu}]", range(0x531, 0x557)),
    (r"[\p{IsArmenian}&&\p{L}]", range(0x561, 0x587)), (r"[\p{IsGeorgian}&&\p{L}]", range(0x10D0, 0x10F1)),
    (r"\p{IsHiragana}", range(0x3042, 0x3094)), (r"\p{IsKatakana}", range(0x30A2, 0x30F4)),
    (r"\p{IsHangul}", range(0xAC00, 0xACC0)), (r"\p{IsHan}", range(0x4E00, 0x4EC0)),
    (r"[\p{IsArabic}&&\p{Nd}]", range(0x660, 0x66A)), (r"[\p{IsDevanagari}&&\p{Nd}]", range(0x966, 0x970)),
    (r"\p{Lu}", range(0x41, 0x5B)), (r"\p{L}", range(0x61, 0x7B)), (r"\p{N}", range(0x30, 0x3A))))
#: What a secret without any letter or digit is drawn from: no white space, no quotes.
SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
#: Syllables of names by script: consonants, vowels, endings for women, men and others.
SYLLABLES = {
    "latin": ("b c d f g k l m n p r s t v".split(), "a e i o u".split(), ("a", "n", "e")),
    "cyrillic": ("б в г д к л м н п р с т".split(), "а е и о у".split(), ("а", "н", "ь")),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε η ι ο".split(), ("α", "ς", "ο")),
}
FAMILY_ENDINGS = {"latin": ("er", "er", "er"), "cyrillic": ("ова", "ов", "ко"), "greek": ("ου", "ης", "ης")}
# -------------------------------------------------------------------------------------------------

ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
NAME = dict(PATTERNS)["name"]
#: Rounds of draws in the format of the original; each later one widens the format by one more character.
SHAPED_ROUNDS = 12
MAX_ROUNDS = 64


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _chars(value: Column, f) -> Column:
    """``f(character, position from 0)`` of every character, joined."""
    parts = F.transform(F.sequence(F.lit(1), F.length(value)),
                        lambda i: _let(value.substr(i, F.lit(1)), lambda c: f(c, i - 1)))
    return F.when(F.length(value) > 0, F.array_join(parts, "")).otherwise(F.lit(""))


def _stream(seed: Column, length: Column) -> Column:
    """At least two hex digits for each of ``length`` characters."""
    blocks = F.transform(F.sequence(F.lit(0), (length / 32).cast("int")),
                         lambda i: F.sha2(F.concat_ws("|", seed, i.cast("string")), 256))
    return F.array_join(blocks, "")


def _byte(stream: Column, i) -> Column:
    at = i * 2 + 1 if isinstance(i, Column) else F.lit(2 * i + 1)
    return F.conv(stream.substr(at, F.lit(2)), 16, 10).cast("int")


def symbols(value: Column, seed: Column) -> Column:
    """Keyed symbols, one for each character."""
    return _let(_stream(seed, F.length(value)), lambda stream: _chars(value, lambda c, i: F.lit(SYMBOLS).substr(
        _byte(stream, i) % len(SYMBOLS) + 1, F.lit(1))))


def reshape(value: Column, seed: Column) -> Column:
    """A keyed look-alike: each letter or digit by another of its alphabet or script, all else as it is."""
    def one(stream, c, i):
        scripts = c
        for cls, letters in reversed(SCRIPTS):
            other = F.lit(letters).substr(_byte(stream, i) % len(letters) + 1, F.lit(1))
            scripts = F.when(c.rlike(cls), other).otherwise(scripts)
        out = F.when(c.rlike(r"[\p{L}\p{M}\p{N}]"), scripts).otherwise(c)
        for a in ALPHABETS:
            other = F.lit(a).substr(_byte(stream, i) % len(a) + 1, F.lit(1))
            out = F.when(F.instr(F.lit(a), c) > 0, other).otherwise(out)
        return out
    return _let(_stream(seed, F.length(value)), lambda stream: _chars(value, lambda c, i: one(stream, c, i)))


def with_check_digit(digits: Column) -> Column:
    """A string of digits and the digit that makes it pass the card number check."""
    def completed(d):
        n = F.length(d)

        def counted(acc, i):
            digit = d.substr(i, F.lit(1)).cast("int")
            twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return acc + F.when((n - i) % 2 == 0, twice).otherwise(digit)
        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), counted)
        return F.concat(d, ((10 - total % 10) % 10).cast("string"))
    return _let(digits, completed)


def script_of(word: Column) -> Column:
    return (F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek")
            .when(word.rlike(r"\p{IsLatin}"), "latin").otherwise("other"))


def _made_name(canonical: Column, gender: Column, seed: Column, attempt: int, endings: dict) -> Column:
    """Syllables of the name's script, more of them in later rounds, and the gender's ending."""
    many = 2 + attempt // 2

    def spelled(stream):
        out = F.lit("")
        for script, (consonants, vowels, given) in SYLLABLES.items():
            c, v = F.array(*map(F.lit, consonants)), F.array(*map(F.lit, vowels))
            body = F.concat(*[F.concat(F.get(c, _byte(stream, 2 * k) % len(consonants)),
                                       F.get(v, _byte(stream, 2 * k + 1) % len(vowels))) for k in range(many)],
                            F.get(c, _byte(stream, 2 * many) % len(consonants)))
            own = endings.get(script, given)
            end = F.when(gender == "f", own[0]).when(gender == "m", own[1]).otherwise(own[2])
            out = F.when(script_of(canonical) == script, F.concat(body, end)).otherwise(out)
        return out
    return _let(_stream(seed, F.lit(32 * (1 + many // 8))), spelled)


def widened(kind: Column, canonical: Column, attempt: int) -> Column:
    """What a round's candidate is shaped like: the canonical form, in later rounds with more digits or letters."""
    more = max(0, attempt - SHAPED_ROUNDS + 1)
    if not more:
        return canonical
    at = F.instr(canonical, "@")
    return (F.when(kind == "email", F.concat(canonical.substr(F.lit(1), at - 1), F.lit("a" * more),
                                             canonical.substr(at, F.length(canonical))))
            .when(kind.isin("secret", "key") & ~canonical.rlike("^[0-9a-f]+$"), F.concat(canonical, F.lit("a" * more)))
            .otherwise(F.concat(canonical, F.lit("0" * more))))


def surrogate(kind: Column, canonical: Column, gender: Column, key: str, attempt: int) -> Column:
    """The candidate of a round for (kind, canonical, gender), in canonical form."""
    seed = F.concat_ws("|", F.lit(key), kind, canonical, F.lit(str(attempt)))
    wide, more = widened(kind, canonical, attempt), max(0, attempt - SHAPED_ROUNDS + 1)
    size, first = F.length(wide), canonical.substr(F.lit(1), F.lit(1))
    host = canonical.substr(F.instr(canonical, "@") + 1, size)
    top = F.regexp_extract(host, r"(\.\p{L}+)$", 1)
    prefix = F.regexp_extract(canonical, r"^(AKIA|gh[a-z]_|sk-)", 1)

    def tail(shaped: Column, start) -> Column:
        return shaped.substr(start if isinstance(start, Column) else F.lit(start), size)
    made = {
        "email": lambda x: F.concat(x.substr(F.lit(1), F.instr(wide, "@")), reshape(
            host.substr(F.lit(1), F.length(host) - F.length(top)), F.concat_ws("|", F.lit(key), F.lit("host"), host)), top),
        "key": lambda x: F.concat(prefix, tail(x, F.length(prefix) + 1)),
        "iban": lambda x: F.concat(canonical.substr(F.lit(1), F.lit(2)), tail(x, 3)),
        "card": lambda x: with_check_digit(F.concat(first, x.substr(F.lit(2), size - 2))),
        "phone": lambda x: F.concat(first, tail(x, 2)),
    }

    def finished(x: Column) -> Column:
        return reduce(lambda out, k: F.when(kind == k, made[k](x)).otherwise(out), made, x)
    octets = _let(_stream(seed, F.lit(4 + more)), lambda s: F.concat_ws(
        ".", *[(_byte(s, i) % 254 + 1).cast("string") for i in range(4 + more)]))
    return (F.when(kind.isin("secret", "hex") & canonical.rlike("^[0-9a-f]+$"),
                   _stream(seed, size).substr(F.lit(1), size))
            .when((kind == "secret") & ~canonical.rlike(r"[\p{L}\p{N}]"), symbols(wide, seed))
            .when(kind == "ip", octets)
            .when(kind.isin("given", "family") & (script_of(canonical) == "other"), reshape(F.concat(
                canonical, F.repeat(first, F.lit(more))), seed))
            .when(kind == "given", _made_name(canonical, gender, seed, attempt, {}))
            .when(kind == "family", _made_name(canonical, gender, seed, attempt, FAMILY_ENDINGS))
            .otherwise(_let(reshape(wide, seed), finished)))


# ---- detection ----------------------------------------------------------------------------------

def has_entity(text: Column) -> Column:
    """Whether a text has an entity: the long pattern runs only over texts with a mark that it needs."""
    marked = reduce(lambda out, m: out | text.contains(m), MARKED, text.rlike(MARKS))
    return (marked & text.rlike(ENTITY)) | text.rlike(NAME)


def kind_of(entity: Column) -> Column:
    return reduce(lambda out, kp: F.when(entity.rlike(f"^(?:{kp[1]})$"), kp[0]).otherwise(out),
                  reversed(PATTERNS), F.lit(None).cast("string"))


def canonical_form(kind: Column, value: Column) -> Column:
    return (F.when(kind.isin("email", "given", "family", "hex"), F.lower(value))
            .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(value, r"\D", ""))
            .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
            .otherwise(value))


def _listed(word: Column, words) -> Column:
    return F.lower(word).isin([w.lower() for w in words])


def segments(hits: DataFrame) -> DataFrame:
    """Rows (doc_id, check, copies, seq, before, kind, value, gender) of texts with entities.

    ``before`` is the unchanged text in front of the value; a name gives a
    row for each of its words, a text a last row without value.
    """
    # one pass of the long pattern: entities between marks made of the text's own hash, then gap, entity, gap ...
    mark = F.concat(F.lit("\ue000"), F.hex("check"), F.lit("\ue001"))
    cut = F.split(F.regexp_replace("text", F.lit(f"({ENTITY})"), F.concat(mark, F.lit("$1"), mark)), mark, -1)
    pairs = _let(cut, lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(2)), lambda i: F.struct(
        F.get(x, i).alias("gap"), F.get(x, i + 1).alias("entity"))))
    # outer, as otherwise a filter on the array's size would make it twice
    rows = hits.select("doc_id", "check", "copies", F.posexplode_outer(pairs).alias("at", "pair"))
    rows = rows.select("doc_id", "check", "copies", "at", "pair.gap", "pair.entity")
    rows = rows.withColumn("kind", kind_of(F.col("entity")))
    # a title stays, the last word after a title or a listed given name is the family name
    context = F.regexp_extract("entity", f"^({_CONTEXT})", 1)
    title = F.concat(context, F.regexp_extract(F.col("entity").substr(F.length(context) + 1, F.length("entity")), f"^({_TITLE} )", 1))
    words = F.split(F.col("entity").substr(F.length(title) + 1, F.length("entity")), " ")
    plain = F.rtrim(F.replace(title.substr(F.length(context) + 1, F.length(title)), F.lit("."), F.lit("")))
    by_title = F.when(plain.isin(*_TITLES_F), "f").when(plain.isin(*_TITLES_M), "m")

    def word(w, i):
        # a context's only word without a title is taken as a given name
        is_given = (_listed(w, _GIVEN_F + _GIVEN_M) | (i < F.size(words) - 1)
                    | ((context != "") & (plain == ""))) & ~((i > 0) & (i == F.size(words) - 1))
        gender = (F.when(is_given & _listed(w, _GIVEN_F), "f").when(is_given & _listed(w, _GIVEN_M), "m")
                  .when(~is_given & w.rlike("(?:ова|ева|ина|ая)$"), "f").when(~is_given & w.rlike("(?:ов|ев|ин|ий)$"), "m")
                  .otherwise(by_title))
        before = F.when(i == 0, F.concat(F.col("gap"), title)).otherwise(F.lit(" "))
        return F.struct(before.alias("before"), F.when(is_given, "given").otherwise("family").alias("kind"),
                        w.alias("value"), gender.alias("gender"))

    label = F.regexp_extract("entity", f"^({SECRET_LABEL})", 1)
    secret = F.col("kind") == "secret"
    whole = F.array(F.struct(
        F.when(secret, F.concat("gap", label)).otherwise(F.col("gap")).alias("before"), F.col("kind").alias("kind"),
        F.when(secret, F.col("entity").substr(F.length(label) + 1, F.length("entity"))).otherwise(F.col("entity")).alias("value"),
        F.lit(None).cast("string").alias("gender")))
    parts = F.when(F.col("kind") == "name", F.transform(words, word)).otherwise(whole)
    rows = rows.select("doc_id", "check", "copies", "at", F.posexplode_outer(parts).alias("nth", "p"))
    return rows.select("doc_id", "check", "copies", F.struct("at", "nth").alias("seq"),
                       "p.before", "p.kind", "p.value", "p.gender",
                       canonical_form(F.col("p.kind"), F.col("p.value")).alias("canonical"))


# ---- surrogates ---------------------------------------------------------------------------------

def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) of distinct (kind, canonical, gender), all surrogates distinct.

    A round keeps, of candidates that are no original and not yet given, the
    one of the smallest canonical value for each; the others draw anew, after
    SHAPED_ROUNDS from ever wider formats.
    """
    originals = staged(entities, "pii-entities")
    pending, given = originals, None
    for attempt in range(MAX_ROUNDS):
        drawn = staged(pending.withColumn("surrogate", surrogate(
            F.col("kind"), F.col("canonical"), F.col("gender"), key, attempt)), "pii-drawn")
        free = drawn.join(originals.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if given is not None:
            free = free.join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = staged(free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
                     .select("kind", "canonical", "surrogate"), "pii-won")
        given = won if given is None else given.union(won)
        pending = staged(drawn.drop("surrogate").join(won.select("kind", "canonical"), ["kind", "canonical"], "left_anti"),
                         "pii-pending")
        if pending.isEmpty():
            return given
    raise ValueError(f"entities without a surrogate after {MAX_ROUNDS} rounds of ever wider formats")


def rendered(kind: Column, value: Column, made: Column) -> Column:
    """A surrogate in the format of the value: its separators, or its case; what is longer follows at the end."""
    def next_char(c, i):
        before = F.length(F.regexp_replace(value.substr(F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("[0-9A-Za-z]"), made.substr(before + 1, F.lit(1))).otherwise(c)
    cased = (F.when((F.length(value) > 1) & (F.upper(value) == value), F.upper(made))
             .when(F.upper(value.substr(F.lit(1), F.lit(1))) == value.substr(F.lit(1), F.lit(1)),
                   F.concat(F.upper(made.substr(F.lit(1), F.lit(1))), made.substr(F.lit(2), F.length(made))))
             .otherwise(made))
    n = F.length(F.regexp_replace(value, "[^0-9A-Za-z]", ""))
    return (F.when(kind.isin("phone", "card", "ssn", "iban"),
                   F.concat(_chars(value, next_char), made.substr(n + 1, F.length(made))))
            .when(kind.isin("given", "family"), cased)
            .when((kind == "hex") & value.rlike("^[0-9A-F]*[A-F][0-9A-F]*$"), F.upper(made)).otherwise(made))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text with surrogates, n_entities, kinds (sorted, distinct).

    Texts without an entity come back as they are (null as empty).  Rows that
    repeat stay repeated and get equal texts; an empty table gives an empty
    result; other columns are not read.  The same key gives the same
    surrogates for the same corpus.
    """
    text = text_or_empty(text_col)
    # the long pattern runs once a text: both branches read its verdict, written with the text
    rows = staged(docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
                  .withColumn("has", has_entity(F.col("text"))), "pii-texts")
    clean = rows.where(~F.col("has")).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"),
                                             F.array().cast("array<string>").alias("kinds"))
    hits = (rows.where("has").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("check", F.xxhash64("text")))
    parts = staged(segments(hits), "pii-segments")
    made = assign_surrogates(parts.where(F.col("kind").isNotNull()).groupBy("kind", "canonical")
                             .agg(F.min("gender").alias("gender")), key)
    # the last stretch of a text has no entity: it stays out of the join, where all of them would have one key
    named = parts.where(F.col("kind").isNotNull()).join(made.hint("merge"), ["kind", "canonical"], "left").select(
        "doc_id", "check", "copies", "seq", "kind",
        F.concat("before", F.coalesce(rendered(F.col("kind"), F.col("value"), F.col("surrogate")), F.lit(""))).alias("piece"))
    ends = parts.where(F.col("kind").isNull()).select(*named.columns[:-1], F.col("before").alias("piece"))
    out = named.unionByName(ends).groupBy("doc_id", "check", "copies").agg(
        F.array_sort(F.collect_list(F.struct("seq", "piece"))).alias("pieces"),
        F.count("kind").alias("n_entities"), F.sort_array(F.collect_set("kind")).alias("kinds"))
    hidden = out.select("doc_id", F.array_join("pieces.piece", "").alias("text"), "n_entities", "kinds",
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")
    return clean.unionByName(hidden)

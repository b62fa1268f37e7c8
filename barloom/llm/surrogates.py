"""Operator 10: personal data replaced by keyed surrogates; DataFrame functions only.

Mentions are found by expressions, and each is read as one or two entities: a kind and a canonical
value, free of case and spacing. A surrogate is drawn from a keyed digest of the entity, in the
form of its kind: the same country code, a card number that is as valid as the original, a given
name of the same gender and script, as many letters and digits. The table of distinct entities is
then checked: where two drew the same surrogate, or one that occurs in the corpus, all but the
first draw again, until every entity has its own. So equal entities stay equal across the corpus
and distinct ones distinct. Texts without mentions are never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.scratch import Scratch
from barloom.llm.texts import free_names, table

#: Titles tell the gender of the name behind them.
MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Господин|Κύριος"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία"
#: Titles that tell nothing of the kind.
NEUTRAL = "Dr|Prof|Professor|Doctor"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
ACCESS = r"\bAKIA[0-9A-Z]{16}\b"
SECRET_NAME = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)"
SECRET = SECRET_NAME + r"[^\s\"']{6,}"
#: Secrets known by how they begin.
TOKEN_HEAD = r"(?:\b[spr]k_(?:live|test)_|\bgh[pousr]_|\bxox[abprs]-)"
TOKEN = TOKEN_HEAD + r"[0-9A-Za-z-]{10,}"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?=(?:[A-Z ]{0,6}[0-9]){6})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
#: In groups behind a country code, unseparated behind one, or national.
NATIONAL = r"(?:\([0-9]{3}\) ?|(?<![0-9.-])[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}\b|\+[1-9][0-9]{7,14}\b|" + NATIONAL
CARD = r"\b[0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}\b|\b[0-9]{13,19}\b"
NUMBER = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
ADDRESS = r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"
ADDRESS_6 = (
    r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|"
    r"(?=[A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
)
#: With hyphens and apostrophes.
NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{L}+(?:[-'’]\p{L}+)*"
PERSON = rf"\b(?:{MALE}|{FEMALE}|{NEUTRAL})\.? {NAME}(?: {NAME})?"
MENTION = "|".join([EMAIL, ACCESS, SECRET, TOKEN, IBAN, PHONE, CARD, NUMBER, ADDRESS, ADDRESS_6, PERSON])
#: What a text with a mention must show, cheap to look for.
GATE = rf"[0-9@]|AKIA|_live_|_test_|gh[pousr]_|xox|\b(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}|(?i:password|passwd|pwd|secret|token|key)\s*[=:]"

SYLLABLES = {
    "latin": "ba da fe ga ha jo ka la mi na or pe ra sa ti ul va we xi zo".split(),
    "cyrillic": "ба да фе га ко ла ми на ор пе ра са ти ул ва зо".split(),
    "greek": "βα δα φε γα κο λα μι να ορ πε ρα σα τι υλ ξα ζω".split(),
}
ENDINGS = {"latin": ("n", "a"), "cyrillic": ("н", "а"), "greek": ("ος", "α")}
#: Draws after which a surrogate grows by a character a draw, so that its room never runs out.
SAME_SIZE_DRAWS = 4


def mentions(text: Column) -> Column:
    """All mentions of a text, in order; empty for null."""
    value = F.coalesce(text, F.lit(""))
    return F.when(value.rlike(GATE), F.regexp_extract_all(value, F.lit(MENTION), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def parts(mention: Column) -> Column:
    """A mention as consecutive pieces: kind (null: kept as it is), canonical value, and the piece."""
    def piece(kind: str | Column | None, canonical: Column | None, text: Column) -> Column:
        return F.struct(
            (F.lit(kind) if not isinstance(kind, Column) else kind).cast("string").alias("kind"),
            (canonical if canonical is not None else F.lit(None)).cast("string").alias("canonical"), text.alias("piece"),
        )

    def kept(text: Column) -> Column:
        return piece(None, None, text)

    def after(prefix: Column) -> Column:
        return F.substr(mention, F.length(prefix) + 1)

    name = F.regexp_extract(mention, "^" + SECRET_NAME, 0)
    country = F.coalesce(
        F.nullif(F.regexp_extract(mention, r"^\+([0-9]{1,3})[^0-9]", 1), F.lit("")), F.regexp_extract(mention, r"^\+(1|7|[0-9]{2})", 1)
    )
    token = F.regexp_extract(mention, "^" + TOKEN_HEAD, 0)
    title = F.regexp_extract(mention, r"^[^ ]+ ", 0)
    names = F.split(after(title), " ")
    gender = F.when(title.rlike(rf"^(?:{FEMALE})\.? $"), "given-f").when(title.rlike(rf"^(?:{NEUTRAL})\.? $"), "given-n").otherwise("given-m")
    family = F.element_at(names, -1)
    return (
        F.when(mention.rlike("^[^@ ]+@"), F.array(piece("email", F.lower(mention), mention)))
        .when(mention.rlike("^" + SECRET_NAME), F.array(kept(name), piece("secret", after(name), after(name))))
        .when(mention.startswith("AKIA"), F.array(kept(F.lit("AKIA")), piece("secret", after(F.lit("AKIA")), after(F.lit("AKIA")))))
        .when(token != "", F.array(kept(token), piece("secret", after(token), after(token))))
        .when(mention.rlike("^[A-Z]{2}[0-9]{2}[ 0-9A-Z]+$"), F.array(piece("iban", F.replace(mention, F.lit(" "), F.lit("")), mention)))
        .when(mention.rlike(f"^{NATIONAL}$"), F.array(piece("phone", F.concat(F.lit("|"), _digits(mention)), mention)))
        .when(mention.startswith("+"), F.array(piece("phone", F.concat(country, F.lit("|"), F.substr(_digits(mention), F.length(country) + 1)), mention)))
        .when(mention.rlike(f"^(?:{ADDRESS})$"), F.array(piece("address", mention, mention)))
        .when(mention.rlike("^[0-9A-Fa-f:]+$") & mention.contains(":"), F.array(piece("address-6", F.lower(mention), mention)))
        .when(mention.rlike("^[0-9]"), F.array(piece("number", _digits(mention), mention)))
        .when(
            F.size(names) > 1,
            F.array(kept(title), piece(gender, F.lower(names[0]), names[0]), kept(F.lit(" ")), piece("family", F.lower(family), family)),
        )
        .otherwise(F.array(kept(title), piece("family", F.lower(family), family)))
    )


def _draw(stream: Column, at: Column | int) -> Column:
    """A number from 0 to 65,535 for a place."""
    place = (at if isinstance(at, Column) else F.lit(at)) % 32
    return F.conv(F.substr(stream, place * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _alike(text: Column, stream: Column) -> Column:
    """Another text of the same letters-and-digits form; hexadecimal stays hexadecimal."""
    hexadecimal = text.rlike("^(?=.*[0-9])[0-9a-f]{8,}$")

    def one(char: Column, at: Column) -> Column:
        n = _draw(stream, at)
        return (
            F.when(char.rlike("[0-9]"), (n % 10).cast("string"))
            .when(char.rlike("[a-z]"), F.char(n % F.when(hexadecimal, 6).otherwise(26) + 97)).when(char.rlike("[A-Z]"), F.char(n % 26 + 65)).otherwise(char)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid."""
    reverse = F.split(F.reverse(body), "")
    doubled = lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10)).otherwise(c.cast("int")).cast("int")
    total = F.aggregate(F.transform(reverse, doubled), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def _hexed(text: Column, stream: Column) -> Column:
    """Other hexadecimal digits in the place of a text's own."""
    one = lambda char, at: F.when(char.rlike("[0-9a-f]"), F.substr(F.lit("0123456789abcdef"), _draw(stream, at) % 16 + 1, F.lit(1))).otherwise(char)
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _modulo_97(text: Column) -> Column:
    """Digits and capital letters as one number, letters counting from 10, modulo 97."""

    def step(rest: Column, char: Column) -> Column:
        return F.when(char.rlike("[0-9]"), (rest * 10 + char.cast("int")) % 97).when(char.rlike("[A-Z]"), (rest * 100 + F.ascii(char) - 55) % 97).otherwise(rest)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _account(canonical: Column, stream: Column, more: Column) -> Column:
    """Another account number of the country, its check digits right if the original's are."""
    country, check, own = F.substr(canonical, F.lit(1), F.lit(2)), F.substr(canonical, F.lit(3), F.lit(2)), F.substr(canonical, F.lit(5))
    other = F.concat(_alike(own, stream), more)
    right = F.lit(98) - _modulo_97(F.concat(other, country, F.lit("00")))
    valid = _modulo_97(F.concat(own, country, check)) == 1
    wrong = (right + 1 + _draw(stream, 31) % 95) % 97
    return F.concat(country, F.lpad(F.when(valid, right).otherwise(wrong).cast("string"), 2, "0"), other)


def _name(piece_kind: Column, canonical: Column, stream: Column, extra: Column) -> Column:
    def of(script: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        count = F.when(piece_kind == "family", 3).otherwise(2) + extra
        made = F.array_join(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.element_at(syllables, _draw(stream, i) % len(SYLLABLES[script]) + 1)), "")
        male, female = ENDINGS[script]
        return F.concat(made, F.when(piece_kind == "given-f", female).when(piece_kind == "given-m", male).otherwise(""))

    return F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(canonical.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def surrogate(kind: Column, canonical: Column, draw: Column, key: str) -> Column:
    """The canonical surrogate of an entity at one draw."""
    def stream(of: str | Column, value: Column, n: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(of) if isinstance(of, str) else of, value, n.cast("string")), 512)

    own = stream(kind, canonical, draw)
    extra = F.greatest(draw - SAME_SIZE_DRAWS + 1, F.lit(0))
    more = F.substr(F.translate(own, "abcdef", "012345"), F.lit(65), extra)
    local, domain = F.split_part(canonical, F.lit("@"), F.lit(1)), F.split_part(canonical, F.lit("@"), F.lit(2))
    tail = F.regexp_extract(domain, r"(?:\.example)?\.[a-z]+$", 0)
    head = F.substr(domain, F.lit(1), F.length(domain) - F.length(tail))
    email = F.concat(_alike(local, own), more, F.lit("@"), _alike(head, stream("domain", domain, F.lit(0))), tail)
    country, rest = F.split_part(canonical, F.lit("|"), F.lit(1)), F.split_part(canonical, F.lit("|"), F.lit(2))
    phone = F.concat(country, F.lit("|"), (_draw(own, 31) % 8 + 2).cast("string"), _alike(F.substr(rest, F.lit(2)), own), more)
    size = F.length(canonical)
    body = F.concat(F.substr(canonical, F.lit(1), F.lit(1)), _alike(F.substr(canonical, F.lit(2), size - 2), own))
    valid = _check_digit(F.substr(canonical, F.lit(1), size - 1)) == F.substr(canonical, size, F.lit(1))
    number = F.concat(body, F.when(valid, _check_digit(body)).otherwise(((_check_digit(body).cast("int") + 1 + _draw(own, 31) % 9) % 10).cast("string")), more)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == 0, F.when(draw < SAME_SIZE_DRAWS, F.lit(10)).otherwise(_draw(own, i) % 223 + 1)).otherwise(_draw(own, i) % 256).cast("string"))
    return (
        F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "number", number)
        .when(kind == "iban", _account(canonical, own, more)).when(kind == "address-6", F.concat(_hexed(canonical, own), more))
        .when(kind == "address", F.array_join(octets, ".")).when(kind == "secret", F.concat(_alike(canonical, own), more))
        .otherwise(_name(kind, canonical, own, extra))
    )


def rendered(kind: Column, piece: Column, drawn: Column) -> Column:
    """A canonical surrogate in the form of a piece: its digits put in place, or its case followed."""
    def placed(signs: Column, which: str) -> Column:
        def step(state: Column, char: Column) -> Column:
            mine = char.rlike(which)
            return F.struct(
                F.when(mine, state["at"] + 1).otherwise(state["at"]).alias("at"),
                F.concat(state["out"], F.when(mine, F.substr(signs, state["at"], F.lit(1))).otherwise(char)).alias("out"),
            )

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
        return F.aggregate(F.split(piece, ""), start, step, lambda s: F.concat(s["out"], F.substr(signs, s["at"])))

    cased = F.when((F.upper(piece) == piece) & (F.length(piece) > 1), F.upper(drawn)).when(
        F.substr(piece, F.lit(1), F.lit(1)) == F.upper(F.substr(piece, F.lit(1), F.lit(1))), F.initcap(drawn)
    ).otherwise(drawn)
    upper = F.when(F.upper(piece) == piece, F.upper(drawn)).otherwise(drawn)
    return (
        F.when(kind.isin("phone", "number"), placed(_digits(drawn), "[0-9]")).when(kind == "iban", placed(drawn, "[0-9A-Z]"))
        .when(kind == "address-6", upper).when(kind.isin("address", "secret", "email"), drawn).otherwise(cased)
    )


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``kind``, ``canonical``, ``surrogate``: each entity of its own, none that is itself an entity."""
    known = scratch.keep(entities.where("kind is not null").distinct(), "pii-entities")
    taken = known.select("kind", F.col("canonical").alias("surrogate"))
    now = known.withColumn("draw", F.lit(0))
    step = 0
    while True:
        drawn = now.withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("draw"), key))
        # an entity that has kept its surrogate longer comes first
        first = Window.partitionBy("kind", "surrogate").orderBy("draw", "canonical")
        drawn = drawn.withColumn("place", F.row_number().over(first)).join(
            taken.withColumn("real", F.lit(1)), ["kind", "surrogate"], "left"
        )
        drawn = scratch.keep(
            drawn.select("kind", "canonical", "surrogate", "draw", ((F.col("place") > 1) | F.col("real").isNotNull()).alias("again")),
            f"pii-draw-{step}",
        )
        scratch.drop(f"pii-draw-{step - 1}")
        if not drawn.where("again").limit(1).count():
            return drawn.select("kind", "canonical", "surrogate")
        now = drawn.select("kind", "canonical", (F.col("draw") + F.col("again").cast("int")).alias("draw"))
        step += 1


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text", count: str | None = "n_replaced") -> DataFrame:
    """All columns of ``docs``, with every mention in ``text`` replaced, and the number of mentions.

    A column named as ``count`` is replaced; ``count=None`` adds none. Null and empty texts stay as
    they are. Repeated rows get the same text. Rows need no id: replacements are gathered by a
    64-bit hash of the text and its length, so what meets is bounded by one text.
    """
    scratch = Scratch(docs.sparkSession)
    plain = docs.drop(*({count} - {text, id_column, None})) if count else docs
    order = [*plain.columns, *([count] if count else [])]
    has, mark, size, given = free_names(order, "mentions", "text_hash", "text_size", "given")
    found = plain.withColumn(has, mentions(F.col(text)))
    own = [F.xxhash64(text).alias(mark), F.length(text).alias(size)]
    # their mentions are found once, and what they are replaced by is looked up twice
    with_some = scratch.keep(found.where(F.size(has) > 0).select("*", *own), "pii-texts")
    without = found.where(F.size(has) == 0)
    said = scratch.keep(
        with_some.select(mark, size, F.explode(F.array_distinct(has)).alias("mention")).distinct(), "pii-mentions"
    )
    forms = scratch.keep(
        said.select("mention").distinct().select("mention", F.posexplode(parts(F.col("mention"))).alias("at", "part"))
        .select("mention", "at", "part.kind", "part.canonical", "part.piece"), "pii-forms",
    )
    owned = assign(forms.select("kind", "canonical"), key, scratch)
    shown = forms.join(owned, ["kind", "canonical"], "left").withColumn(
        "shown", F.when(F.col("kind").isNull(), F.col("piece")).otherwise(rendered(F.col("kind"), F.col("piece"), F.col("surrogate")))
    )
    new = scratch.keep(
        shown.groupBy("mention").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "shown"))).getField("shown"), "").alias("new")), "pii-shown"
    )
    maps = said.join(new, "mention").groupBy(mark, size).agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias(given))
    # written, so that the join's shuffles stand alone and a text of many copies can be split
    maps = scratch.keep(maps, "pii-maps")
    scratch.drop("pii-mentions", "pii-forms", "pii-shown", *(n for n in list(scratch.folders) if n.startswith("pii-draw")))
    joined = with_some.join(maps, [mark, size], "left").drop(mark, size)
    pieces = F.split(F.col(text), MENTION, -1)
    put = F.zip_with(
        pieces, F.transform(has, lambda m: F.element_at(given, m)),
        lambda piece, replacement: F.concat(piece, F.coalesce(replacement, F.lit(""))),
    )
    done = joined.withColumn(text, F.array_join(put, "")).drop(given)
    out = done.unionByName(without)
    if count:
        out = out.withColumn(count, F.size(has).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in order])


#: The registered query's key. Real runs pass one of their own, kept out of the code.
QUERY_KEY = "key of the registered query"


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, QUERY_KEY)

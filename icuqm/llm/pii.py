"""Personal data replaced by keyed surrogates, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.session import write_stage

_TITLE_M = r"Mr|Sir|Herr|Herrn|Monsieur|Señor|Sr|Mister"
_TITLE_F = r"Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Lady"
_TITLE_N = r"Dr|Prof|Professor"
#: A name, also with an apostrophe, inner capitals or a hyphen, and one with a given name or initials before it.
_NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)*(?:-\p{Lu}\p{Ll}+)*"
_FULL = rf"(?:(?:\p{{Lu}}\. ?){{1,3}}|{_NAME} )?{_NAME}"
_KEYWORD = r"(?i:token|secret|password|passwd|api_key|apikey)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What is found, in order of precedence, as the kind and its pattern. Possessive runs and
#: look-behinds let a match start only where a run starts, so long runs are read once.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}](?:[\p{L}\p{N}\-]*+\.)+\p{L}{2,24}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{4,5}|\d{13,19})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+.])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+.])\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "secret": r"(?<![\p{L}\p{N}_\-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_\-]{20,}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}_\-])"
    # quoted values, JSON among them, and bare ones with a digit or mark in them
    rf"|(?<={_KEYWORD}[\"']? ?[=:] ?[\"'])[^\s\"']{{1,128}}(?=[\"'])"
    rf"|(?<={_KEYWORD}[=:])(?=[^\s\"',;]*[0-9!@#$%^&*+/_\-])[^\s\"',;]{{6,128}}",
    "name": rf"(?<=\b(?:{_TITLE_M}|{_TITLE_F}|{_TITLE_N})\.? ){_FULL}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without any of these holds nothing to find; the full pattern then is not run on it.
HINT = rf"@|\d[\d .()\-]{{5,}}\d|\b(?:{_TITLE_M}|{_TITLE_F}|{_TITLE_N})\b|AKIA|[0-9a-f]{{32}}|[0-9A-F]{{32}}|gh[pousr]_|sk-|{_KEYWORD}[\"']? ?[=:]"
#: Characters that mark what was found; a text that holds them is cut by the pattern itself.
OPENED, CLOSED = "\ue000", "\ue001"
#: Given names by gender and script, and syllables of family names by script.
GIVEN = {
    "man": {"latin": "James Peter Henry Simon Oscar Felix Martin Louis Paul Adrian Victor Leon Hugo Bruno Edgar Ralph", "cyrillic": "Иван Пётр Олег Борис Павел Глеб Денис Антон", "greek": "Νίκος Πέτρος Γιώργος Κώστας Σπύρος Αλέξης Μάριος Πάνος"},
    "woman": {"latin": "Alice Clara Emma Julia Laura Maria Nora Sofia Irene Helen Diana Paula Vera Marta Eva Rosa", "cyrillic": "Анна Ольга Мария Елена Ирина Дарья Нина Вера", "greek": "Μαρία Ελένη Άννα Σοφία Ειρήνη Δήμητρα Ζωή Χαρά"},
    "person": {"latin": "Robin Alex Sascha Kim Noa Jamie Charlie Dana Sam Toni Jules Andrea Nico Lou Rene Mika", "cyrillic": "Саша Женя Валя Слава Никита Паша Шура Тоня", "greek": "Αλεξ Χρις Σταυρ Ηλι Δαν Βασιλ Ανδρ Φανη"},
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te va",
    "cyrillic": "ба бо ва ви га го да до жа за ка ко ла ло ма мо на но па по ра ро са со та то фа ха ца ча ша",
    "greek": "βα βο γα γο δα δο ζα ζο κα κο λα λο μα μο να νο πα πο ρα ρο σα σο τα το φα φο χα χο ψα ψο θα",
}
#: How card numbers of known issuers begin.
ISSUED = "^(?:2[2-7]|3[0-9]|4|5[0-9]|6)"
#: Digits of the shortest phone number.
SHORTEST_PHONE = 7
#: From this attempt on a surrogate of fixed length grows by one character an attempt.
GROWS = 6


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn(digits: Column, first: int) -> Column:
    """Sum of digits, each second one doubled; ``first`` 0 starts with a plain digit on the right."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when((i + first) % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def kind_of(found: Column) -> Column:
    """The kind of a match, from its own text; names carry the kind of their title beside it."""
    rules = {
        "email": found.contains("@"),
        "ip": F.rlike(found, F.lit(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")),
        "ssn": F.rlike(found, F.lit(r"^\d{3}-\d{2}-\d{4}$")),
        "iban": F.rlike(found, F.lit(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3}")),
        "number": F.rlike(found, F.lit(r"^[+(\d][\d .()\-]*\d$")),
        "name": F.rlike(found, F.lit(rf"^{_FULL}$")),
    }
    kind = None
    for name, fits in rules.items():
        kind = F.when(fits, name) if kind is None else kind.when(fits, name)
    return kind.otherwise("secret")


def _at(index: Column, words: str) -> Column:
    """The word at ``index`` of a fixed list."""
    own = words.split()
    return F.get(F.array(*[F.lit(w) for w in own]), F.pmod(index, F.lit(len(own))).cast("int"))


def _number(draw: Column, place: Column | int, width: int = 7) -> Column:
    """A number from hexadecimal digits of a draw."""
    return F.conv(F.substr(draw, F.lit(place) if isinstance(place, int) else place, F.lit(width)), 16, 10).cast("long")


def _alike(text: Column, draw: Column) -> Column:
    """Each letter and digit replaced within its class and script; marks stay, but where there is nothing else."""
    marks = ~F.rlike(text, F.lit(r"[\p{L}\p{N}]"))
    hexadecimal = F.rlike(text, F.lit("^[0-9]*[a-f][0-9a-f]*$"))

    def one(i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        k = _number(draw, 1 + (i * 3) % 250, 4)

        def of(alphabet: str) -> Column:
            return F.substr(F.lit(alphabet), (k % len(alphabet) + 1).cast("int"), F.lit(1))

        return (
            F.when(marks, of("abcdefghijklmnopqrstuvwxyz"))
            .when(hexadecimal, of("0123456789abcdef"))
            .when(F.rlike(c, F.lit("[0-9]")), of("0123456789"))
            .when(F.rlike(c, F.lit("[a-z]")), of("abcdefghijklmnopqrstuvwxyz"))
            .when(F.rlike(c, F.lit("[A-Z]")), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(F.rlike(c, F.lit(r"\p{IsCyrillic}")), of("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(F.rlike(c, F.lit(r"\p{IsGreek}")), of("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(F.rlike(c, F.lit(r"\p{L}")), of("àáâäèéêëìíîïòóôöùúûüñç"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _stream(draw: Column, length: Column) -> Column:
    """``length`` decimal digits from a draw."""
    parts = [F.lpad((_number(draw, 1 + 13 * k, 13) % 10**15).cast("string"), 15, "0") for k in range(3)]
    return F.substr(F.concat(*parts), F.lit(1), length)


def iban_check(country: Column, body: Column) -> Column:
    """The two check digits of a bank number: 98 less the rest by 97 of its digits, letters counting from 10 on."""
    text = F.concat(body, country, F.lit("00"))

    def add(rest: Column, i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        value = F.when(F.rlike(c, F.lit("[0-9]")), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.lpad((98 - F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)).cast("string"), 2, "0")


def surrogate(kind: Column, canonical: Column, draw: Column, attempt: int = 0) -> Column:
    """The replacement of one entity: of its kind, gender, script and format.

    Names gain a syllable with each attempt; what has a fixed length grows from attempt
    ``GROWS`` on. So there always are more surrogates than entities.
    """
    n = F.length(canonical)
    stream = _stream(draw, n)
    body = F.concat(F.substr(canonical, F.lit(1), F.lit(1)), F.substr(stream, F.lit(2), n - 2))
    card = F.concat(body, ((10 - _luhn(body, 1) % 10) % 10).cast("string"))
    code = F.substr(canonical, F.lit(1), F.greatest(n - 10, F.lit(0)))
    ten = F.concat((_number(draw, 60) % 8 + 2).cast("string"), F.substr(stream, F.lit(2), F.lit(2)), (_number(draw, 70) % 8 + 2).cast("string"), F.substr(stream, F.lit(5), F.lit(6)))
    more = max(0, attempt + 1 - GROWS)
    digits = _stream(F.substr(draw, F.lit(200), F.lit(300)), F.lit(min(more, 45)))
    letters = F.substr(_alike(F.lit("x" * max(more, 1)), F.substr(draw, F.lit(300), F.lit(200))), F.lit(1), F.lit(more))
    phone = F.concat(F.when(n >= 10, F.concat(code, ten)).otherwise(stream), digits)
    ip = F.concat_ws(".", *[(_number(draw, 1 + 8 * k) % (15 if k == 0 else 256) + (240 if k == 0 else 0)).cast("string") for k in range(4)])
    if more:
        ip = F.concat_ws(".", ip, digits)
    ssn = F.concat(F.lit("9"), F.substr(stream, F.lit(2), F.lit(8)), digits)
    country = F.substr(canonical, F.lit(1), F.lit(2))
    account = F.concat(_alike(F.substr(canonical, F.lit(5), n), draw), digits)
    iban = F.concat(country, iban_check(country, account), account)
    ends = F.element_at(F.split(canonical, "@"), -1)
    host = _alike(F.regexp_extract(ends, r"^(.*?)\.\p{L}+$", 1), F.substr(draw, F.lit(100), F.lit(300)))
    email = F.concat(_alike(F.element_at(F.split(canonical, "@"), 1), draw), letters, F.lit("@"), host, F.lit(".example"))
    script = F.when(F.rlike(canonical, F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.rlike(canonical, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")
    given = family = None
    for s, syllables in SYLLABLES.items():
        further = [_at(_number(draw, 40 + 9 * k), syllables) for k in range(attempt)]
        for gender, names in GIVEN.items():
            fits = (script == s) & (kind == f"given-{gender}")
            name = F.concat(_at(_number(draw, 1), names[s]), *further)
            given = F.when(fits, name) if given is None else given.when(fits, name)
        name = F.initcap(F.concat(*[_at(_number(draw, 1 + 9 * k), syllables) for k in range(4)], *further))
        family = F.when(script == s, name) if family is None else family.when(script == s, name)
    return (
        F.when(kind == "email", email).when(kind == "card", F.concat(card, digits)).when(kind == "phone", phone).when(kind == "ip", ip)
        .when(kind == "ssn", ssn).when(kind == "iban", iban).when(kind == "family", family).when(F.startswith(kind, F.lit("given-")), given)
        .otherwise(F.concat(_alike(canonical, draw), letters))
    )


def _draw(key: str, kind: Column, canonical: Column, attempt: int) -> Column:
    """512 hexadecimal digits under the key, and 128 more for every attempt after the third."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"{attempt}.{k}"), kind, canonical).cast("binary"), 512) for k in range(max(4, attempt + 2))])


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canonical, fresh)`` with no two entities of a kind alike and none like an entity of the corpus.

    All entities draw; of those that collide the smallest keeps its draw and the others
    draw again, as do those that hit a real one. Later draws also avoid what is settled and
    come from a larger space, so it ends whatever the number of entities. All names
    are of one kind in this.
    """
    entities = write_stage(entities.distinct(), "pii-entities")
    settled, waiting, attempt = None, entities, 0
    while True:
        drawn = waiting.withColumn("fresh", surrogate(F.col("kind"), F.col("canonical"), _draw(key, F.col("kind"), F.col("canonical"), attempt), attempt))
        real = entities.select(_space(F.col("kind")).alias("space"), F.col("canonical").alias("fresh")).distinct()
        free = drawn.withColumn("space", _space(F.col("kind"))).join(real, ["space", "fresh"], "left_anti")
        if settled is not None:
            free = free.join(settled.select(_space(F.col("kind")).alias("space"), "fresh"), ["space", "fresh"], "left_anti")
        won = free.groupBy("space", "fresh").agg(F.min(F.struct("canonical", "kind")).alias("own")).select("own.kind", "own.canonical", "fresh")
        settled = write_stage(won if settled is None else settled.unionByName(won), "pii-settled")
        waiting = write_stage(waiting.join(settled, ["kind", "canonical"], "left_anti"), "pii-waiting")
        if waiting.isEmpty():
            return settled
        attempt += 1


def _sexless(kind: Column) -> Column:
    return F.when(F.startswith(kind, F.lit("given-")), "given").otherwise(kind)


def _space(kind: Column) -> Column:
    """Kinds whose surrogates must differ from one another and from what they replace."""
    return F.when(_sexless(kind).isin("given", "family"), "name").otherwise(kind)


def _fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""

    def one(i: Column) -> Column:
        c = F.substr(shape, i, F.lit(1))
        return F.when(F.rlike(c, F.lit(r"\d")), F.substr(digits, F.length(_digits(F.substr(shape, F.lit(1), i))), F.lit(1))).otherwise(c)

    rest = F.substr(digits, F.length(_digits(shape)) + 1, F.length(digits))
    return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), ""), rest)


def pieces_of(text: Column) -> Column:
    """The text cut into what lies between findings, at even places, and the findings, at odd ones, by one pass of the pattern."""
    marked = F.regexp_replace(text, F.lit(ANY), F.lit(f"{OPENED}$0{CLOSED}"))
    cut = F.split(marked, f"[{OPENED}{CLOSED}]", -1)
    # a text that holds the marks themselves
    found, between = F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.split(text, ANY, -1)
    slow = F.flatten(F.transform(between, lambda b, i: F.when(i < F.size(found), F.array(b, F.get(found, i))).otherwise(F.array(b))))
    return F.when(F.rlike(text, F.lit(f"[{OPENED}{CLOSED}]")), slow).otherwise(cut)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and a column ``n_replaced``.

    Found are e-mail addresses, phone, card, social security and bank numbers, IPv4
    addresses, secrets and names after a title. The same entity gets the same surrogate in
    every document under one key, whatever its spelling (letter case, separators); a name's
    parts are entities of their own, so full and short forms still agree. Card numbers must
    begin like an issuer's and pass the Luhn check, and their surrogates do so too, as those
    of bank numbers pass theirs. A name found after a title is also replaced where it stands
    alone in the same text; a given name has one surrogate whatever the titles; initials
    stay.

    Defined results: null text stays null with 0 replaced; a text without findings is
    unchanged; rows are judged by text alone, so repeats and null ids are no matter; an
    empty table gives an empty result; other columns are carried along, whatever their
    names. A column ``n_replaced`` of the input is replaced. A very long text is one row and
    is read whole.
    """
    docs = docs.drop("n_replaced")
    hit = F.coalesce(F.rlike("text", F.lit(HINT)), F.lit(False))
    # the input's columns lie in a struct, so that no name of theirs can clash
    row = F.struct(*[F.col(c) for c in docs.columns])
    cut = docs.select(row.alias("row"), F.when(hit, pieces_of(F.col("text"))).alias("pieces"))
    cut = cut.select("row", F.when(F.size("pieces") > 1, F.col("pieces")).alias("pieces"))
    cut = write_stage(cut.withColumn("sha", F.when(F.col("pieces").isNotNull(), F.sha2(F.col("row.text").cast("binary"), 256))), "pii-cut")
    found = cut.where("pieces is not null").select("sha", "pieces")
    each = found.select("sha", F.posexplode("pieces").alias("i", "raw"), "pieces").where("i % 2 = 1")
    each = each.select("sha", "i", "raw", F.get("pieces", F.col("i") - 1).alias("before")).distinct()
    title = F.regexp_extract("before", r"(\p{L}+)\.? $", 1)
    gender = F.when(F.rlike(title, F.lit(f"^(?:{_TITLE_M})$")), "man").when(F.rlike(title, F.lit(f"^(?:{_TITLE_F})$")), "woman").otherwise("person")
    digits = _digits(F.col("raw"))
    kind = kind_of(F.col("raw"))
    number = F.when((F.length(digits) >= 13) & ~F.startswith("raw", F.lit("+")), "card").otherwise("phone")
    each = each.select("sha", "i", "raw", F.when(kind == "number", number).otherwise(kind).alias("kind"), gender.alias("gender"))
    words = F.split("raw", r"(?<=\.) ?(?=\p{Lu})| ")
    plain = F.struct(
        F.col("kind").alias("kind"),
        F.when(F.col("kind") == "email", F.lower("raw")).when(F.col("kind").isin("card", "phone", "ssn"), digits).when(F.col("kind") == "iban", F.replace("raw", F.lit(" "), F.lit(""))).otherwise(F.col("raw")).alias("canonical"),
    )
    given = F.struct(F.lit("given").alias("kind"), F.get(words, F.lit(0)).alias("canonical"))
    family = F.struct(F.lit("family").alias("kind"), F.element_at(words, -1).alias("canonical"))
    # initials alone tell no person and stay
    named = (F.size(words) > 1) & ~F.endswith(F.get(words, F.lit(0)), F.lit("."))
    own = F.when(F.col("kind") != "name", F.array(plain)).when(named, F.array(given, family)).otherwise(F.array(family))
    issued = F.rlike(digits, F.lit(ISSUED)) & (_luhn(digits, 0) % 10 == 0)
    each = each.where((F.col("kind") != "card") | issued).where((F.col("kind") != "phone") | (F.length(digits) >= SHORTEST_PHONE))
    parts = each.select("sha", "i", "raw", "gender", F.explode(own).alias("entity"))
    parts = write_stage(parts.select("sha", "i", "raw", "gender", "entity.kind", "entity.canonical"), "pii-parts")
    # a given name has one gender: that of its titles where they agree
    sexes = parts.where("kind = 'given'").groupBy("canonical").agg(F.bool_or(F.col("gender") == "man").alias("man"), F.bool_or(F.col("gender") == "woman").alias("woman"))
    sexed = F.concat(F.lit("given-"), F.when(F.col("man") & ~F.col("woman"), "man").when(F.col("woman") & ~F.col("man"), "woman").otherwise("person"))
    entities = parts.where("kind <> 'given'").select("kind", "canonical").union(sexes.select(sexed.alias("kind"), "canonical"))
    settled = assign(entities, key).withColumn("kind", _sexless(F.col("kind")))
    told = parts.join(settled, ["kind", "canonical"])
    shaped = F.when(F.col("kind").isin("card", "phone", "ssn"), _fill(F.col("raw"), F.col("fresh"))).when(F.col("kind") == "iban", _refill(F.col("raw"), F.col("fresh"))).otherwise(F.col("fresh"))
    named = F.col("kind").isin("given", "family")
    told = told.select("sha", "i", "raw", shaped.alias("fresh"), F.when(named, F.struct("canonical", "fresh")).alias("name"))
    # a name's parts are put into the found text, other findings are replaced whole
    names = F.array_sort(F.collect_set("name"))
    one = told.groupBy("sha", "i", "raw").agg(F.min("fresh").alias("whole"), names.alias("names"))
    shown = F.when(F.size("names") > 0, _renamed(F.col("raw"), F.col("names"))).otherwise(F.col("whole"))
    put = one.groupBy("sha").agg(
        F.map_from_entries(F.collect_list(F.struct("i", shown.alias("s")))).alias("put"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"),
        F.count("*").cast("long").alias("n_replaced"),
    )
    # a name found in a text is replaced where it stands alone, too
    swapped = lambda piece, i: F.when(i % 2 == 1, F.coalesce(F.element_at("put", i), piece)).otherwise(_renamed(piece, F.col("names")))
    changed = cut.where("pieces is not null").join(put, "sha")
    fresh = F.array_join(F.transform("pieces", swapped), "")
    changed = changed.select("row", fresh.alias("fresh"), "n_replaced")
    same = cut.where("pieces is null").select("row", F.col("row.text").cast("string").alias("fresh"), F.lit(0).cast("long").alias("n_replaced"))
    same = same.union(cut.where("pieces is not null").join(put, "sha", "left_anti").select("row", F.col("row.text").cast("string"), F.lit(0).cast("long")))
    columns = [F.col("fresh").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return changed.union(same).select(*columns, "n_replaced")


def _renamed(text: Column, names: Column) -> Column:
    """``text`` with every name of ``names (canonical, fresh)`` that stands as a word replaced."""
    word = lambda name: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), name["canonical"], F.lit(r"(?![\p{L}\p{N}])"))
    return F.when(F.size(names) > 0, F.aggregate(names, text, lambda own, name: F.regexp_replace(own, word(name), name["fresh"]))).otherwise(text)


def _refill(shape: Column, letters: Column) -> Column:
    """``shape`` with its characters but blanks replaced in order."""

    def one(i: Column) -> Column:
        c = F.substr(shape, i, F.lit(1))
        return F.when(c != " ", F.substr(letters, F.length(F.replace(F.substr(shape, F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), "")

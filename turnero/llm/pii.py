"""Personal data and secrets replaced by keyed surrogates.

Detected entities are e-mail addresses, phone numbers, payment cards, social
security numbers, bank accounts, IPv4 addresses, secrets and titled names.  An
entity's canonical form (digits of a phone number, an address in lower case)
decides its surrogate, so every spelling in every document gets the same one
(coreference), drawn from a keyed hash: nobody without the key can redo it.  A
surrogate keeps the type, the length, the punctuation, the case, a card's
checksum, and for names the gender, the script and the number of names.

Two entities that draw the same surrogate, or one that draws a real entity of
the corpus, are found by aggregates over all entities; the later ones draw
again until all differ.  Only the entities that drew again are joined back to
their texts; all others are computed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.llm.common import stored

KEY = "surrogates-1"
#: Draws after which an address may grow.
FORM_KEPT = 8

# Titles that announce a person's name, by gender, and names to draw from, by script and gender.
TITLES = {"m": "Mr Herr Monsieur Señor Sr Господин Κύριος".split(),
          "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа Κυρία".split()}
NAMES = {
    "latin": {"m": "Adam Bruno Carl David Emil Felix Gustav Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul".split(),
              "f": "Alma Berta Clara Diana Emma Flora Greta Helena Ida Julia Klara Laura Maria Nora Olga Paula".split(),
              "last": "Abel Bauer Castro Duval Egger Fabre Gallo Hansen Iglesias Jansen Keller Lopez Moreau Novak Ortega Perrin".split()},
    "cyrillic": {"m": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
                 "f": "Анна Вера Галина Дарья Елена Жанна Ирина Ольга".split(),
                 "last": "Бондаренко Гончаренко Демченко Ильченко Коваленко Лисенко Мороз Шевченко".split()},
    "greek": {"m": "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Λουκάς Νίκος Πέτρος".split(),
              "f": "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία".split(),
              "last": "Αθανασίου Βασιλείου Γεωργίου Δημητρίου Ιωάννου Νικολάου Παύλου Χρήστου".split()},
}

_TITLE = "(?:" + "|".join(TITLES["m"] + TITLES["f"]) + ")\\.?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Kind -> pattern; where two could begin at a place the earlier one wins.
PATTERNS = {
    "person": "(?<!\\p{L})" + _TITLE + "[ ]\\p{Lu}[\\p{L}'-]+(?:[ ]\\p{Lu}[\\p{L}'-]+){0,2}",
    # A host name has up to 127 labels of up to 63 characters; without that bound the search recurses once per label.
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": "(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}"
              "|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])|(?<=[=:] ?[\"'])[A-Za-z0-9+/_=-]{16,}(?=[\"'])",
    "iban": "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": "(?<![0-9.])(?:" + _OCTET + "\\.){3}" + _OCTET + "(?!\\.?[0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": "(?<![0-9])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])",
    "phone": "(?<![0-9+])(?:\\+[0-9]{1,3}[ .-]?)?\\([0-9]{2,4}\\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             "|(?<![0-9+])\\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9+.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
PATTERN = "|".join(PATTERNS.values())
BY_DIGITS = ("ssn", "card", "phone", "iban")
# What every match of the patterns holds, beside an @, a title or a mark: without any of it a text is not searched.
CORES = ("[0-9](?:(?<=[+][0-9])|(?<=[(][0-9])[0-9]{1,3}[)]|(?<=[A-Z]{2}[0-9])[0-9]|[.][0-9]{1,3}[.]|-[0-9]{2}-[0-9]"
         "|[0-9]{3}[ -]?[0-9]{4}|[0-9]{2}[ .-][0-9]{3}[ .-])",
         "[\"'](?<=[=:] ?[\"'])[A-Za-z0-9+/_=-]{16}",
         "[0-9a-fA-F]{32}")
MARKS = ("@", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_of(e: str) -> str:
    """SQL for the kind of an entity, from how it looks."""
    tests = "".join(f" WHEN {e} rlike {quoted('^(?:' + PATTERNS[k] + ')$')} THEN '{k}'" for k in ("iban", "ip", "ssn", "card"))
    return (f"CASE WHEN contains({e}, '@') AND {e} rlike {quoted('^(?:' + PATTERNS['email'] + ')$')} THEN 'email' "
            f"WHEN {e} rlike {quoted('^' + _TITLE + ' ')} THEN 'person' {tests} "
            f"WHEN {e} rlike '^[0-9+(]' AND NOT {e} rlike '[A-Za-z]' AND {e} rlike '[ ().+-]' THEN 'phone' ELSE 'secret' END")


def canon_of(kind: str, e: str) -> str:
    """SQL for the canonical form: equal for all spellings of one entity."""
    by_digits = ", ".join(f"'{k}'" for k in BY_DIGITS)
    men = quoted("^(?:" + "|".join(TITLES["m"]) + ")\\.? ")
    name = f"regexp_replace({e}, {quoted('^' + _TITLE + ' ')}, '')"
    return (f"CASE WHEN {kind} IN ({by_digits}) THEN upper(regexp_replace({e}, '[^0-9A-Za-z]', '')) "
            f"WHEN {kind} = 'email' THEN lower({e}) "
            f"WHEN {kind} = 'person' THEN concat(CASE WHEN {e} rlike {men} THEN 'm' ELSE 'f' END, ' ', lower({name})) ELSE {e} END")


def _pick(words: list[str], n: str) -> str:
    return f"element_at(array({', '.join(map(quoted, words))}), cast(pmod({n}, {len(words)}) as int) + 1)"


def _person(canon: str, stream: str, attempt: str) -> str:
    """SQL for a name of the same gender, script and number of names; later attempts add a second last name."""
    numbers = [f"cast(conv(substr({stream}, {1 + 8 * k}, 7), 16, 10) as bigint)" for k in range(4)]
    scripts = []
    for script, test in (("cyrillic", r"\\p{IsCyrillic}"), ("greek", r"\\p{IsGreek}"), ("latin", "")):
        names = NAMES[script]
        first = f"CASE WHEN startswith({canon}, 'm') THEN {_pick(names['m'], numbers[0])} ELSE {_pick(names['f'], numbers[0])} END"
        second = f"CASE WHEN startswith({canon}, 'm') THEN {_pick(names['m'], numbers[1])} ELSE {_pick(names['f'], numbers[1])} END"
        last = f"concat({_pick(names['last'], numbers[2])}, CASE WHEN {attempt} > 1 THEN concat('-', {_pick(names['last'], numbers[3])}) ELSE '' END)"
        more = f"concat({last}, CASE WHEN {attempt} > 4 THEN concat('-', initcap(translate(substr({stream}, 40, 6), '0123456789', 'aeioulmnrs'))) ELSE '' END)"
        made = (f"CASE size(split({canon}, ' ')) WHEN 2 THEN {more} WHEN 3 THEN concat({first}, ' ', {more}) "
                f"ELSE concat({first}, ' ', {second}, ' ', {more}) END")
        scripts.append(f"WHEN {canon} rlike '{test}' THEN {made}" if test else f"ELSE {made}")
    return f"CASE {' '.join(scripts)} END"


def _letters(kind: str, canon: str, stream: str) -> str:
    """SQL for a surrogate of the same characters' classes: digit for digit, letter for letter of the same case."""
    def at(i: str) -> str:
        return f"instr('0123456789abcdef', substr({stream}, {i} % 128 + 1, 1)) - 1"

    number = f"(({at('i')}) * 16 + {at('(i + 61)')})"
    # What holds for the whole entity is worked out once and bound to v: a step per character, however long it is.
    head = (f"CASE {kind} WHEN 'phone' THEN 1 WHEN 'card' THEN 1 WHEN 'iban' THEN 2 "
            f"WHEN 'secret' THEN length(regexp_extract({canon}, '^(AKIA|gh[a-z]_|sk-|xox[a-z]-)?', 1)) ELSE 0 END")
    tail = f"length({canon}) - CASE WHEN {kind} = 'email' THEN length(element_at(split({canon}, '[.]'), -1)) ELSE 0 END"
    hexed = f"{kind} = 'secret' AND {canon} rlike '^([0-9a-f]+|[0-9A-F]+)$'"
    once = f"named_struct('head', {head}, 'tail', {tail}, 'hexed', {hexed}, 'upper', {canon} rlike '[A-F]')"
    walk = (f"array_join(transform(split({canon}, ''), (c, i) -> CASE WHEN i < v.head OR i >= v.tail THEN c "
            f"WHEN v.hexed AND c rlike '[0-9a-fA-F]' THEN CASE WHEN v.upper THEN upper(substr({stream}, i % 128 + 1, 1)) ELSE substr({stream}, i % 128 + 1, 1) END "
            f"WHEN c between '0' and '9' THEN cast({number} % 10 as string) "
            f"WHEN c between 'a' and 'z' THEN substr('abcdefghijklmnopqrstuvwxyz', {number} % 26 + 1, 1) "
            f"WHEN c between 'A' and 'Z' THEN substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', {number} % 26 + 1, 1) ELSE c END), '')")
    return f"element_at(transform(array({once}), v -> {walk}), 1)"


def _luhn(number: str) -> str:
    """SQL for the Luhn sum of a string of digits."""
    return (f"aggregate(transform(reverse(split({number}, '')), (c, i) -> CASE WHEN i % 2 = 0 THEN cast(c as int) "
            f"ELSE cast(c as int) * 2 - CASE WHEN cast(c as int) > 4 THEN 9 ELSE 0 END END), 0, (s, x) -> s + x)")


def surrogate_of(kind: str, canon: str, attempt: str, key: str) -> str:
    """SQL for the canonical surrogate of a canonical entity."""
    seed = f"concat({quoted(key)}, '|', {kind}, '|', {canon}, '|', {attempt}, '|'"
    drawn, stream = f"concat(sha2({seed}, '0'), 256), sha2({seed}, '1'), 256))", "stream"  # drawn once, bound by the outer lambda
    octets = ", ".join(f"cast(1 + cast(conv(substr({stream}, {1 + 4 * k}, 4), 16, 10) as int) % 254 as string)" for k in range(4))
    # An address whose form has few others gets a longer local part after some draws.
    longer = f"concat(translate(substr({stream}, 100, 12), '0123456789', 'ghijklmnop'), {_letters(kind, canon, stream)})"
    letters = f"CASE WHEN {kind} = 'email' AND {attempt} > {FORM_KEPT} THEN {longer} ELSE {_letters(kind, canon, stream)} END"
    # A card that satisfies the checksum gets a last digit that satisfies it too.
    body = "substr(x, 1, length(x) - 1)"
    summed = _luhn(f"concat({body}, '0')")
    checked = f"element_at(transform(array({letters}), x -> concat({body}, cast((10 - {summed} % 10) % 10 as string))), 1)"
    made = (f"CASE WHEN {kind} = 'ip' THEN concat_ws('.', {octets}) WHEN {kind} = 'person' THEN {_person(canon, stream, attempt)} "
            f"WHEN {kind} = 'card' AND {_luhn(canon)} % 10 = 0 THEN {checked} ELSE {letters} END")
    return f"element_at(transform(array({drawn}), stream -> {made}), 1)"


def rendered(kind: str, e: str, surrogate: str) -> str:
    """SQL for the surrogate in the spelling of one occurrence: its punctuation, spacing, case and title."""
    by_digits = ", ".join(f"'{k}'" for k in BY_DIGITS)
    walk = (f"aggregate(split({e}, ''), named_struct('o', '', 'k', 0), (s, c) -> CASE WHEN c rlike '[0-9A-Za-z]' "
            f"THEN named_struct('o', concat(s.o, substr({surrogate}, s.k + 1, 1)), 'k', s.k + 1) "
            f"ELSE named_struct('o', concat(s.o, c), 'k', s.k) END, s -> s.o)")
    cased = f"array_join(zip_with(split({e}, ''), split({surrogate}, ''), (c, x) -> CASE WHEN c between 'A' and 'Z' THEN upper(x) ELSE x END), '')"
    title = f"regexp_extract({e}, {quoted('^' + _TITLE + ' ')}, 0)"
    name = f"CASE WHEN substr({e}, length({title}) + 1) = upper(substr({e}, length({title}) + 1)) THEN upper({surrogate}) ELSE {surrogate} END"
    return (f"CASE WHEN {kind} IN ({by_digits}) THEN {walk} WHEN {kind} = 'email' THEN {cased} "
            f"WHEN {kind} = 'person' THEN concat({title}, {name}) ELSE {surrogate} END")


def may_hold(text: str) -> Column:
    """False only where no pattern can match: plain searches, far cheaper than the patterns."""
    body = F.col(text)
    found = F.lit(False)
    for word in (*MARKS, *(f"{t}{end}" for t in TITLES["m"] + TITLES["f"] for end in (" ", ". "))):
        found = found | F.contains(body, F.lit(word))
    for core in CORES:
        found = found | body.rlike(core)
    return F.coalesce(found, F.lit(False))


def entities(text: str) -> Column:
    """Array of ``(e, kind, canon)`` in the order of the text in column ``text``."""
    found = f"regexp_extract_all(`{text}`, {quoted(PATTERN)}, 0)"
    kinds = f"transform({found}, e -> named_struct('e', e, 'kind', {kind_of('e')}))"
    return F.expr(f"transform({kinds}, x -> named_struct('e', x.e, 'kind', x.kind, 'canon', {canon_of('x.kind', 'x.e')}))")


def distinct_surrogates(found: DataFrame, key: str = KEY, rounds: int = 64) -> DataFrame:
    """``(kind, canon)`` of the entities that had to draw again, and their final ``surrogate``.

    ``found`` has one row per distinct entity.  Of several entities with one
    surrogate the smallest canonical form keeps it; a surrogate that is itself
    an entity of the corpus is refused.  Entities of a form that has too few
    others are an error, never a silent collision; addresses get a longer one.
    """
    draw = lambda rows, n: rows.withColumn("surrogate", F.expr(surrogate_of("kind", "canon", f"{n}", key)))
    real = found.select(F.col("kind").alias("k"), F.col("canon").alias("real"))

    def losers(rows: DataFrame) -> DataFrame:
        """Of ``rows`` with ``fresh``, the fresh ones whose surrogate is taken or real."""
        holder = rows.groupBy("kind", "surrogate").agg(
            F.min(F.struct("fresh", "canon")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
                F.col("kind").alias("k"), F.col("surrogate").alias("s"), F.col("first.canon").alias("owner"))
        shared = rows.where("fresh").join(holder, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s"))).where("canon <> owner")
        own = F.lower(F.concat(F.substring("canon", 1, 2), F.col("surrogate")))
        as_canon = F.when(F.col("kind") == "person", own).otherwise(F.col("surrogate"))
        taken = rows.where("fresh").withColumn("own", as_canon).join(real, (F.col("kind") == F.col("k")) & (F.col("own") == F.col("real")))
        return shared.select("kind", "canon").unionByName(taken.select("kind", "canon")).distinct()

    current = stored(draw(found, 0).withColumn("fresh", F.lit(True)), "surrogates")
    again = stored(losers(current), "surrogates")
    settled = None
    for attempt in range(1, rounds):
        if again.isEmpty():
            break
        # The entities that keep their surrogate, and those that draw again.
        kept = current.join(again, ["kind", "canon"], "left_anti").withColumn("fresh", F.lit(False))
        fresh = draw(again, attempt).withColumn("fresh", F.lit(True))
        current = stored(kept.unionByName(fresh), "surrogates")
        drawn = current.where("fresh").select("kind", "canon", "surrogate")
        again = stored(losers(current), "surrogates")
        won = drawn.join(again, ["kind", "canon"], "left_anti")
        settled = won if settled is None else settled.unionByName(won)
    if not again.isEmpty():
        raise ValueError(f"{again.count()} entities have no surrogate of their form that differs from all others after {rounds} draws")
    if settled is None:
        settled = draw(again, 0).select("kind", "canon", "surrogate")
    return stored(settled, "surrogates")


def replace(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and two more columns: ``n_entities`` and ``entity_kinds``.

    Null texts stay null with no entities, texts without entities stay as they
    are; repeated rows give repeated rows; all other columns are kept, but for
    earlier ones of the two names, which are replaced; an empty table gives no rows.  The whole text is searched.  An entity has the same
    surrogate wherever it occurs; different entities have different ones.
    """
    body = F.col(text)
    p = "_"  # begins the names of the columns made here, and no other
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    # A filter on the entities would find them twice; texts without any are few behind may_hold.
    found = stored(docs.where(may_hold(text)).select(F.xxhash64(body).alias("text_hash"), entities(text).alias("entities")), "entities")
    listed = found.select("text_hash", F.explode("entities").alias("x")).select("text_hash", "x.kind", "x.canon")
    distinct = stored(listed.select("kind", "canon").distinct(), "entity-table")
    redrawn = distinct_surrogates(distinct, key)
    # Texts that hold an entity which drew again, with its surrogate; few, and joined by their stored size.
    own = stored(listed.distinct().join(redrawn, ["kind", "canon"]).groupBy("text_hash").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws("|", "kind", "canon").alias("k"), F.col("surrogate").alias("v")))).alias("redrawn")), "redrawn")
    own = own.select(F.col("text_hash").alias(f"{p}of"), F.col("redrawn").alias(f"{p}redrawn"))
    marked = docs.withColumn(f"{p}hash", F.xxhash64(body)).join(own, F.col(f"{p}hash") == F.col(f"{p}of"), "left")
    none = F.array().cast("array<struct<e:string,kind:string,canon:string>>")
    marked = marked.withColumn(f"{p}may", may_hold(text)).withColumn(f"{p}found", F.when(F.col(f"{p}may"), entities(text)).otherwise(none))
    mine = f"coalesce(element_at({p}redrawn, concat(x.kind, '|', x.canon)), {surrogate_of('x.kind', 'x.canon', '0', key)})"
    drawn = F.expr(f"transform({p}found, x -> named_struct('e', x.e, 'kind', x.kind, 's', {mine}))")
    marked = marked.withColumn(f"{p}drawn", drawn)
    new = F.expr(f"transform({p}drawn, x -> {rendered('x.kind', 'x.e', 'x.s')})")
    gaps = F.split(body, PATTERN, -1)
    whole = F.array_join(F.zip_with(gaps, F.col(f"{p}new"), lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    kinds = F.array_sort(F.array_distinct(F.expr(f"transform({p}found, x -> x.kind)")))
    made = {"n_entities": F.coalesce(F.size(f"{p}found"), F.lit(0)).cast("bigint"),
            "entity_kinds": F.coalesce(kinds, F.array().cast("array<string>"))}
    kept = [F.when(F.size(f"{p}found") > 0, whole).otherwise(body).alias(c) if c == text else F.col(c) for c in docs.columns if c not in made]
    return marked.withColumn(f"{p}new", new).select(*kept, *(value.alias(name) for name, value in made.items()))

"""Deterministic generation of value-exact pairs: templates by slots, all draws from md5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.functions import text as t
from dictaspark.operators.sample import sample_per_group, weighted_choice

# Families and weights by group, and the share of rows that get a hesitation.
WEIGHTS = {
    ("itn", "fr"): {"entier": 18, "montant": 20, "date": 16, "heure": 16, "pourcent": 6, "telephone": 4, "email": 6, "deja_chiffres": 8, "sans_nombre": 6},
    ("itn", "en"): {"entier": 14, "montant": 15, "date": 12, "heure": 12, "pourcent": 5, "telephone": 4, "email": 3, "deja_chiffres": 18, "sans_nombre": 17},
    ("correction", "fr"): {"pardon": 15, "enfin": 11, "plutot": 9, "veux_dire": 8, "non_sec": 10, "nombre": 12, "faux_depart": 8, "non_reponse": 13,
                           "enfin_discursif": 7, "double_valeur": 7, "plutot_comparatif": 8},
    ("correction", "en"): {"pardon": 15, "enfin": 11, "plutot": 9, "veux_dire": 8, "non_sec": 10, "nombre": 12, "faux_depart": 8, "non_reponse": 13,
                           "enfin_discursif": 7, "double_valeur": 7, "plutot_comparatif": 8},
    ("compo", "fr"): {"compo2": 65, "compo3": 35},
    ("compo", "en"): {"compo2": 65, "compo3": 35},
    ("paragraphes", "en"): {"sujets": 65, "meme_sujet": 35},
}
for _lang in ("fr", "en"):
    WEIGHTS[("forme", _lang)] = {"vide": 8, "pas_vide": 8, "question": 13, "affirmation": 7, "question_indirecte": 7, "faux_depart_nu": 10, "liste": 12, "liste_en_prose": 7,
                                 "liste_trop_courte": 5, "email": 10, "email_en_general": 6, "url": 12, "point_ordinaire": 7}
    WEIGHTS[("coritn", _lang)] = {"jour_heure": 17, "lieu_montant": 15, "prenom_date": 14, "nombre_x": 16, "faux_depart": 13, "non_non_correctif": 14, "deux_valeurs": 11}
HESITATION = {("itn", "fr"): 0.18, ("itn", "en"): 0.20, ("correction", "fr"): 0.20, ("correction", "en"): 0.20, ("compo", "fr"): 0.18, ("compo", "en"): 0.20,
              ("coritn", "fr"): 0.22, ("coritn", "en"): 0.25}
ONES = {"en": "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(),
        "fr": "zéro un deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize dix-sept dix-huit dix-neuf".split()}
TENS = {"en": "twenty thirty forty fifty sixty seventy eighty ninety".split(), "fr": "vingt trente quarante cinquante soixante".split()}
MONTHS = {"en": "January February March April May June July August September October November December".split(),
          "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()}
DAYS = {"en": "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split(), "fr": "lundi mardi mercredi jeudi vendredi samedi dimanche".split()}
NAMES = ("Alix Bruno Claire Denis Emma Farid Gina Hugo Irene Jonas Karim Lena Marco Nadia Oscar Paula Quentin Rosa Samir Tessa Ugo Vera Walid Xenia Yann Zoe Adele Basil Carla Dario Elsa Felix Greta Henri Ilan "
         "Julie Kevin Lina Milo Nora Olga Pablo Rania Simon Talia Ulric Vanda Wendy Yasmin Zack Agnes Boris Cora Diego Edith Fanny Gaspard Hanna Igor Jade Kenza Louis Mina Noel Odile Pierre Ramon Selma Theo "
         "Ursula Victor Wanda Yves Zelda Anton Berta Cyril Dora Elias Flora Gilles Heidi Ivan Judith Klaus Laura Malik Nina Otto Petra Rachid Sonia Tomas Viola Wilma Yuri Zita Arno Bella Cesar").split()
NOISE = {"en": ["um", "uh", "hmm"], "fr": ["euh", "bah", "ben"]}
EVENTS = {"en": [f"the {e}" for e in "visit call review lunch training meeting audit workshop survey dinner trip move repair tour demo exam concert market parade ceremony briefing contest lecture auction picnic rehearsal inspection fair election transfer".split()],
          "fr": "la visite|l'appel|la réunion|le déjeuner|la formation|le bilan|l'audit|l'atelier|l'enquête|le dîner|le voyage|le déménagement|la réparation|la tournée|la démonstration|l'examen|le concert|le marché|le défilé|la cérémonie|le point presse|le concours|la conférence|la vente|le goûter|la répétition|l'inspection|la foire|le vote|le transfert".split("|")}


def spoken(n: int, lang: str) -> str:
    """A number below a million in words."""
    if n < 20:
        return ONES[lang][n]
    if lang == "en":
        if n < 100:
            return TENS["en"][n // 10 - 2] + (f" {ONES['en'][n % 10]}" if n % 10 else "")
        if n < 1000:
            return f"{ONES['en'][n // 100]} hundred" + (f" and {spoken(n % 100, lang)}" if n % 100 else "")
        return f"{spoken(n // 1000, lang)} thousand" + (f" {'and ' if n % 1000 < 100 else ''}{spoken(n % 1000, lang)}" if n % 1000 else "")
    if n < 70:
        tens, one = TENS["fr"][n // 10 - 2], n % 10
        return tens + (" et un" if one == 1 else f"-{ONES['fr'][one]}" if one else "")
    if n < 80:
        return "soixante et onze" if n == 71 else f"soixante-{ONES['fr'][n - 60]}"
    if n < 100:
        return "quatre-vingts" if n == 80 else f"quatre-vingt-{ONES['fr'][n - 80]}"
    if n < 1000:
        head, rest = ("cent" if n < 200 else f"{ONES['fr'][n // 100]} cent"), n % 100
        return head + (f" {spoken(rest, lang)}" if rest else "s" if n >= 200 else "")
    thousands = n // 1000
    head = "mille" if thousands == 1 else f"{spoken(thousands, lang).removesuffix('s') if thousands % 100 in (0, 80) else spoken(thousands, lang)} mille"
    return head + (f" {spoken(n % 1000, lang)}" if n % 1000 else "")


def spoken_table(spark: SparkSession, lang: str, most: int = 10_000) -> DataFrame:
    """``(value, words)`` below ``most``: a dimension table of fixed size, built from the rule."""
    return spark.createDataFrame([(n, spoken(n, lang)) for n in range(most)], "value int, words string")


def _pick(options: list[str], draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(draw, F.lit(len(options))) + 1).cast("int"))


def _draw(seed: str, name: str) -> Column:
    return t.hash_draw(f"{seed}:{name}", F.col("n"))


def quotas(weights: dict[str, int], rows: int) -> dict[str, int]:
    """Rows by family in proportion to the weights, largest remainders first."""
    total = sum(weights.values())
    out = {name: rows * w // total for name, w in weights.items()}
    for name in sorted(weights, key=lambda f: -(rows * weights[f] % total))[: rows - sum(out.values())]:
        out[name] += 1
    return out


# Draws a row asked for, by round; a later round is made where a family is short of distinct texts.
ROUNDS = (4, 40)


def pairs(spark: SparkSession, group: str, lang: str, rows: int, seed: str = "7", holdout: float = 0.08) -> DataFrame:
    """``pair`` rows of one generator group.

    One set of draws renders both sides. Repeated raw texts keep their first row, before
    a hesitation is put in front of some, and more are drawn until every family has its
    quota of distinct texts or 40 times the rows are drawn; a share of each family is held
    out. The reference's byte-identical output is not aimed at: schema, families, weights,
    uniqueness, hold-out and exact values are.
    """
    for tries in ROUNDS:
        unique = _distinct(spark, group, lang, rows, seed, tries)
        if tries == ROUNDS[-1] or unique.count() == rows:
            return _finished(unique, group, lang, seed, holdout)


def _distinct(spark: SparkSession, group: str, lang: str, rows: int, seed: str, tries: int) -> DataFrame:
    """``(dirty, n, family, clean)``: each family's first distinct texts of ``tries`` draws a row, up to its quota."""
    weights = WEIGHTS[(group, lang)]
    base = spark.range(rows * tries).select(F.col("id").alias("n"))
    base = base.withColumn("family", weighted_choice(_draw(seed, "family") / F.lit(float(1 << 32)), {k: float(v) for k, v in weights.items()}))
    small, big = (F.pmod(_draw(seed, "a"), F.lit(98)) + 2).cast("int"), (F.pmod(_draw(seed, "b"), F.lit(9800)) + 101).cast("int")
    base = base.withColumn("x", small).withColumn("y", big).withColumn("x2", F.pmod(F.col("x") + 1 + F.pmod(_draw(seed, "c"), F.lit(90)), F.lit(97)).cast("int") + 2)
    table = F.broadcast(spoken_table(spark, lang))
    for name in ("x", "y", "x2"):
        base = base.join(table.withColumnsRenamed({"value": name, "words": f"{name}_words"}), name)
    who, day, day2, what = _pick(NAMES, _draw(seed, "who")), _pick(DAYS[lang], _draw(seed, "day")), _pick(DAYS[lang], _draw(seed, "day") + 1 + F.pmod(_draw(seed, "d2"), F.lit(6))), _pick(EVENTS[lang], _draw(seed, "what"))
    month = _pick(MONTHS[lang], _draw(seed, "month"))
    hour, minute = (F.pmod(F.col("x"), F.lit(11)) + 1).cast("int"), F.element_at(F.array(F.lit(10), F.lit(20), F.lit(40), F.lit(50)), (F.pmod(F.col("y"), F.lit(4)) + 1).cast("int"))
    ones = F.create_map(*[x for k in range(60) for x in (F.lit(k), F.lit(spoken(k, lang)))])
    base = base.withColumns({"who": who, "day": day, "day2": day2, "what": what, "month": month, "hour": hour, "minute": minute})
    base = base.withColumns({"hour_words": F.element_at(ones, F.col("hour")), "minute_words": F.element_at(ones, F.col("minute")),
                             "dom": (F.pmod(F.col("x2"), F.lit(27)) + 2).cast("int")})
    base = base.withColumn("dom_words", F.element_at(ones, F.col("dom")))
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    c = lambda name: F.col(name).cast("string")
    en = lang == "en"
    money = s("$", t.thousands(F.col("y"), "en")) if en else s(t.thousands(F.col("y"), "fr"), " euros")
    forms: dict[str, tuple[Column, Column]] = {
        "entier": (s("there are ", c("y_words"), " boxes for ", c("who")), s("There are ", t.thousands(F.col("y"), "en"), " boxes for ", c("who"), ".")) if en
        else (s("il y a ", c("y_words"), " cartons pour ", c("who")), s("Il y a ", t.thousands(F.col("y"), "fr"), " cartons pour ", c("who"), ".")),
        "montant": (s(c("what"), " costs ", c("y_words"), " dollars"), s(t.capitalise(F.col("what")), " costs ", money, ".")) if en
        else (s(c("what"), " coûte ", c("y_words"), " euros"), s(t.capitalise(F.col("what")), " coûte ", money, ".")),
        "date": (s(c("what"), " is on ", F.lower("month"), " ", c("dom_words")), s(t.capitalise(F.col("what")), " is on ", c("month"), " ", c("dom"), ".")) if en
        else (s(c("what"), " est le ", c("dom_words"), " ", c("month")), s(t.capitalise(F.col("what")), " est le ", c("dom"), " ", c("month"), ".")),
        "heure": (s(c("what"), " starts at ", c("hour_words"), " ", c("minute_words"), " p m"), s(t.capitalise(F.col("what")), " starts at ", c("hour"), ":", c("minute"), "pm.")) if en
        else (s(c("what"), " commence à ", c("hour_words"), " heures ", c("minute_words")), s(t.capitalise(F.col("what")), " commence à ", c("hour"), "h", c("minute"), ".")),
        "pourcent": (s(c("x_words"), " percent of the rows are for ", c("who")), s(c("x"), "% of the rows are for ", c("who"), ".")) if en
        else (s(c("x_words"), " pour cent des lignes sont pour ", c("who")), s(c("x"), " % des lignes sont pour ", c("who"), ".")),
        "telephone": (s(c("who"), " is on extension ", F.array_join(F.transform(F.split(c("y"), ""), lambda d: F.element_at(ones, F.coalesce(d.try_cast("int"), F.lit(0)))), " ")), s(c("who"), " is on extension ", c("y"), ".")) if en
        else (s(c("who"), " est au poste ", F.array_join(F.transform(F.split(c("y"), ""), lambda d: F.element_at(ones, F.coalesce(d.try_cast("int"), F.lit(0)))), " ")), s(c("who"), " est au poste ", c("y"), ".")),
        "email": (s("write to ", F.lower("who"), " dot ", c("x"), " at example dot com"), s("Write to ", F.lower("who"), ".", c("x"), "@example.com.")) if en
        else (s("écris à ", F.lower("who"), " point ", c("x"), " arobase example point com"), s("Écris à ", F.lower("who"), ".", c("x"), "@example.com.")),
        "deja_chiffres": (s("order ", c("y"), " goes to ", c("who")), s("Order ", c("y"), " goes to ", c("who"), ".")) if en
        else (s("la commande ", c("y"), " va à ", c("who")), s("La commande ", c("y"), " va à ", c("who"), ".")),
        "sans_nombre": (s(c("who"), " moves ", c("what"), " to ", c("day")), s(c("who"), " moves ", c("what"), " to ", c("day"), ".")) if en
        else (s(c("who"), " déplace ", c("what"), " à ", c("day")), s(c("who"), " déplace ", c("what"), " à ", c("day"), ".")),
    }
    repair = {"pardon": ("sorry", "pardon"), "enfin": ("I mean", "enfin"), "plutot": ("rather", "plutôt"), "veux_dire": ("I mean to say", "je veux dire"), "non_sec": ("no", "non")}
    for name, (marker_en, marker_fr) in repair.items():
        forms[name] = ((s(c("who"), " moves ", c("what"), " to ", c("day"), f" {marker_en} ", c("day2")), s(c("who"), " moves ", c("what"), " to ", c("day2"), ".")) if en
                       else (s(c("who"), " déplace ", c("what"), " à ", c("day"), f" {marker_fr} ", c("day2")), s(c("who"), " déplace ", c("what"), " à ", c("day2"), ".")))
    forms["nombre"] = ((s("we need ", c("x_words"), " sorry ", c("x2_words"), " chairs for ", c("who")), s("We need ", c("x2"), " chairs for ", c("who"), ".")) if en
                       else (s("il faut ", c("x_words"), " pardon ", c("x2_words"), " chaises pour ", c("who")), s("Il faut ", c("x2"), " chaises pour ", c("who"), ".")))
    forms["faux_depart"] = ((s("I will I will ask ", c("who"), " about ", c("what")), s("I will ask ", c("who"), " about ", c("what"), ".")) if en
                            else (s("je vais je vais demander à ", c("who"), " pour ", c("what")), s("Je vais demander à ", c("who"), " pour ", c("what"), ".")))
    keep = {"non_reponse": ("no ", "non "), "enfin_discursif": ("finally ", "enfin "), "plutot_comparatif": ("rather ", "plutôt ")}
    for name, (lead_en, lead_fr) in keep.items():
        body = s(lead_en if en else lead_fr, c("who"), " takes " if en else " prend ", c("what"), " on " if en else " le ", c("day"))
        forms[name] = (body, s(t.capitalise(body), "."))
    both = s(c("who"), " takes " if en else " prend ", c("day"), " and " if en else " et ", c("day2"))
    forms["double_valeur"] = (both, s(both, "."))
    day_line = s(c("who"), " moves ", c("what"), " to " if en else " à ") if en else s(c("who"), " déplace ", c("what"), " à ")
    two = s(c("who"), " and " if en else " et ", c("day"))
    item = [s(t.capitalise(F.col(x)) if en else F.col(x)) for x in ("what", "day", "day2")]
    bullets = s("- ", item[0], "\n- ", item[1], "\n- ", item[2])
    spoken_list = s(c("what"), ", ", c("day"), ", ", c("day2"))
    noise = _pick(NOISE[lang], _draw(seed, "hum"))
    body = s(c("who"), " is waiting for ", c("what")) if en else s(c("who"), " attend ", c("what"))
    address = s("www.", F.lower("who"), c("x"), ".example")
    said_address = s(("w w w dot " if en else "w w w point "), F.lower("who"), " ", c("x_words"), (" dot example" if en else " point example"))
    price_said, price = s(c("y_words"), " dollars" if en else " euros"), money
    forms |= {
        "vide": (s(noise, F.repeat(s(" ", _pick(NOISE[lang], _draw(seed, "hum2"))), (F.pmod(F.col("y"), F.lit(40)) + 1).cast("int")), " ", _pick(NOISE[lang], _draw(seed, "hum3"))), F.lit("")),
        "pas_vide": (s(noise, " ", body, " ", noise), s(body, ".")),
        "question": ((s("does ", c("who"), " know about ", c("what")), s("Does ", c("who"), " know about ", c("what"), "?")) if en
                     else (s("est-ce que ", c("who"), " sait pour ", c("what")), s("Est-ce que ", c("who"), " sait pour ", c("what"), " ?"))),
        "affirmation": (s(c("who"), " knows about ", c("what")) if en else s(c("who"), " sait pour ", c("what")), s(c("who"), " knows about " if en else " sait pour ", c("what"), ".")),
        "question_indirecte": ((s("I wonder if ", c("who"), " comes on ", c("day")), s("I wonder if ", c("who"), " comes on ", c("day"), ".")) if en
                               else (s("je me demande si ", c("who"), " vient ", c("day")), s("Je me demande si ", c("who"), " vient ", c("day"), "."))),
        "faux_depart_nu": ((s("we could we will see ", c("who"), " on ", c("day")), s("We will see ", c("who"), " on ", c("day"), ".")) if en
                           else (s("on pourrait on verra ", c("who"), " ", c("day")), s("On verra ", c("who"), " ", c("day"), "."))),
        "liste": ((s(c("who"), " needs three things ", spoken_list), s(c("who"), " needs three things:\n", bullets)) if en
                  else (s(c("who"), " a trois choses ", spoken_list), s(c("who"), " a trois choses :\n", bullets))),
        "liste_en_prose": ((s(c("who"), " needs ", spoken_list), s(c("who"), " needs ", spoken_list, ".")) if en else (s(c("who"), " demande ", spoken_list), s(c("who"), " demande ", spoken_list, "."))),
        "liste_trop_courte": (s("for " if en else "pour ", two), s("For " if en else "Pour ", two, ".")),
        "email": ((s("hello ", body, " best regards"), s("Hello,\n\n", body, ".\n\nBest regards")) if en else (s("bonjour ", body, " cordialement"), s("Bonjour,\n\n", body, ".\n\nCordialement"))),
        "email_en_general": (body, s(body, ".")),
        "url": (s("see " if en else "voir ", said_address), s("See " if en else "Voir ", address, ".")),
        "point_ordinaire": ((s("at this point ", c("who"), " takes ", c("what")), s("At this point ", c("who"), " takes ", c("what"), ".")) if en
                            else (s("on fait le point avec ", c("who"), " ", c("day")), s("On fait le point avec ", c("who"), " ", c("day"), "."))),
        "compo2": (s(forms["montant"][0], (" and " if en else " et "), c("who"), (" is there at " if en else " est là à "), c("hour_words"), (" " if en else " heures "), c("minute_words"), " p m" if en else ""),
                   s(t.capitalise(F.col("what")), (" costs " if en else " coûte "), money, (" and " if en else " et "), c("who"), (" is there at " if en else " est là à "), c("hour"), (":" if en else "h"), c("minute"), "pm." if en else ".")),
        "compo3": (s(forms["montant"][0], (" and " if en else " et "), c("x_words"), (" percent go to " if en else " pour cent vont à "), c("who"), (" on " if en else " le "), *( (F.lower("month"), " ", c("dom_words")) if en else (c("dom_words"), " ", c("month")) )),
                   s(t.capitalise(F.col("what")), (" costs " if en else " coûte "), money, (" and " if en else " et "), c("x"), ("% go to " if en else " % vont à "), c("who"), (" on " if en else " le "), *( (c("month"), " ", c("dom")) if en else (c("dom"), " ", c("month")) ), ".")),
        "jour_heure": (s(day_line, c("day"), (" no " if en else " non "), c("day2"), (" at " if en else " à "), c("hour_words"), (" " if en else " heures "), c("minute_words"), " p m" if en else ""),
                       s(day_line, c("day2"), (" at " if en else " à "), c("hour"), (":" if en else "h"), c("minute"), "pm." if en else ".")),
        "lieu_montant": (s(c("what"), (" costs " if en else " coûte "), c("x_words"), (" sorry " if en else " pardon "), price_said), s(t.capitalise(F.col("what")), (" costs " if en else " coûte "), price, ".")),
        "prenom_date": ((s(c("who"), " comes on ", F.lower("month"), " ", c("x_words"), " I mean ", F.lower("month"), " ", c("dom_words")), s(c("who"), " comes on ", c("month"), " ", c("dom"), ".")) if en
                        else (s(c("who"), " vient le ", c("x_words"), " enfin le ", c("dom_words"), " ", c("month")), s(c("who"), " vient le ", c("dom"), " ", c("month"), "."))),
        "nombre_x": forms["nombre"],
        "non_non_correctif": ((s("no ", c("who"), " takes ", c("x_words"), " chairs"), s("No ", c("who"), " takes ", c("x"), " chairs.")) if en
                              else (s("non ", c("who"), " prend ", c("x_words"), " chaises"), s("Non ", c("who"), " prend ", c("x"), " chaises."))),
        "deux_valeurs": ((s(c("who"), " takes ", c("x_words"), " chairs and ", c("x2_words"), " lamps"), s(c("who"), " takes ", c("x"), " chairs and ", c("x2"), " lamps.")) if en
                         else (s(c("who"), " prend ", c("x_words"), " chaises et ", c("x2_words"), " lampes"), s(c("who"), " prend ", c("x"), " chaises et ", c("x2"), " lampes."))),
    }
    first, second = s(c("who"), " is waiting for ", c("what"), " on ", c("day")), s("the budget for ", c("what"), " is ", c("y_words"), " dollars")
    forms["sujets"] = (s(first, " ", second), s(first, ".\n\nThe budget for ", c("what"), " is ", money, "."))
    forms["meme_sujet"] = (s(first, " ", F.lower("who"), " also asked for ", c("x_words"), " chairs"), s(first, ". ", c("who"), " also asked for ", c("x"), " chairs."))
    dirty = clean = None
    for name in weights:
        raw, out = forms[name]
        dirty = F.when(F.col("family") == name, raw) if dirty is None else dirty.when(F.col("family") == name, raw)
        clean = F.when(F.col("family") == name, out) if clean is None else clean.when(F.col("family") == name, out)
    made = base.select("n", "family", dirty.alias("dirty"), clean.alias("clean"))
    unique = made.groupBy("dirty").agg(F.min_by(F.struct("n", "family", "clean"), "n").alias("r")).select("dirty", "r.*")
    quota = F.element_at(F.create_map(*[F.lit(x) for kv in quotas(weights, rows).items() for x in kv]), F.col("family"))
    return unique.withColumn("rank", F.row_number().over(Window.partitionBy("family").orderBy("n"))).filter(F.col("rank") <= quota).drop("rank")


def _finished(unique: DataFrame, group: str, lang: str, seed: str, holdout: float) -> DataFrame:
    held = sample_per_group(unique, ["family"], "n", f"{seed}:held", holdout).select("n", F.lit(True).alias("held_out"))
    marked = unique.join(held, "n", "left")
    noisy = _draw(seed, "noise") / F.lit(float(1 << 32)) < HESITATION.get((group, lang), 0.0)
    spoken_side = F.when(noisy, F.concat(_pick(NOISE[lang], _draw(seed, "which")), F.lit(" "), F.col("dirty"))).otherwise(F.col("dirty"))
    structure = F.when(F.col("family").isin("liste", "liste_trop_courte"), "lists").otherwise("prose")
    context = F.when(F.col("family") == "email", "email").otherwise("general")
    control = t.control_line(F.lit("semi-formal"), structure, context, F.lit(lang))
    return marked.select(
        F.concat(F.lit(f"{group[:3]}-"), F.lpad(F.col("n").cast("string"), 8, "0")).alias("id"), F.concat(F.lit(f"{group[:3]}-"), "family").alias("file"),
        F.lit(group).alias("source"), F.lit(lang).alias("lang"), F.coalesce("held_out", F.lit(False)).alias("held_out"), F.lit("semi-formal").alias("styling"),
        structure.alias("structure"), context.alias("context"), control.alias("control"), spoken_side.alias("dirty"), "clean")

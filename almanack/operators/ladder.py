"""The match ladder: of an institution's candidate titles the one that continues its reference title.

Candidates become rows with features, computed once per distinct title; pairs are scored once per distinct pair, in
three modes; then every level, tier and class of the ladder is one conditional minimum of one aggregate per
institution, so the whole ladder costs one shuffle by institution, and one by pair of titles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import compare as C
from ..sources.tables import kept
from .candidates import distinct_by_key, none

FUZZY = 0.80
#: Modes of scoring: with synonyms, with parentheses.
MODES = {"raw": (False, True), "canonical": (False, False), "syn": (True, False)}
#: The ladder's levels in order, and the mode each one is scored or explained in.
LEVELS = (("strict_raw", "raw"), ("strict_canonical", "canonical"), ("fuzzy_raw", "raw"), ("fuzzy_canonical", "canonical"), ("fuzzy_syn", "syn"))
# Thresholds of the tiers, lower and upper bound and how far below the fuzzy threshold; for ethnic and race families, else.
RENAME_THRESHOLD = 0.55
CREDENTIAL_THRESHOLDS = ((0.66, 0.76, 0.08), (0.70, 0.78, 0.06))
FAMILY_THRESHOLDS = (0.50, 0.52)
BACKSTOP_THRESHOLDS = ((0.50, 0.58, 0.22), (0.50, 0.62, 0.15))
OVERRIDE_SLACK = 0.05


def title_features(titles: DataFrame) -> DataFrame:
    """``title`` (distinct, plain form) with its keys, tokens and flags."""
    t = F.col("title")
    out = titles.select(
        "title", C.strict_key(t).alias("key"), C.canonical(t, parentheses=False).alias("bare"), C.is_signal(t).alias("signal"), C.has_credential(t).alias("credential"), C.is_strong(t).alias("strong"),
        C.is_rename_family(t).alias("rename"), C.is_navigation(t).alias("navigation"), C.is_nonprogram(t).alias("nonprogram"), C.has_year(t).alias("year"), C.is_mega(t).alias("mega"),
        C.is_boilerplate(t).alias("boilerplate"), C.boilerplate_penalty(t).alias("penalty"), C.is_fragment(t).alias("fragment"), C.is_taxonomy_label(t).alias("taxonomy"),
        C.is_academic_ref(t).alias("academic"), C.is_organisation(t).alias("organisation"), C.families(t).alias("families"), C.rescue_anchor(t).alias("anchor"), C.tokens(t).alias("tokens"),
        F.length(t).alias("n"), C.title_class(t, F.lit(True)).alias("class_cv"), C.title_class(t, F.lit(False)).alias("class_any"),
    )
    out = out.withColumn("bare_key", C.strict_key(F.col("bare")))
    for mode, (synonyms, parentheses) in MODES.items():
        text = C.canonical(t) if parentheses else F.col("bare")
        text = C.with_synonyms(text) if synonyms else text
        out = out.withColumn(f"loose_{mode}", C.loose_key(text)).withColumn(f"tokens_{mode}", C.tokens(text))
    return out


def _bonus(mode: str) -> Column:
    """Domain, intent and entity bonus of a pair."""
    r, c = F.col("r.families"), F.col("c.families")
    roots = F.array(F.lit("black"), F.lit("africana"))
    narrower = F.arrays_overlap(r, roots) & F.array_contains(c, "african") & ~F.arrays_overlap(c, roots)
    small = (F.size(f"r.tokens_{mode}") < 2) | (F.size(f"c.tokens_{mode}") < 2) | (F.size(r) == 0) | (F.size(c) == 0)
    domain = F.when(small, 0.0).when(narrower, -0.10).when(F.arrays_overlap(r, c), 0.12).when(C.related(r, c), 0.06).otherwise(0.0)
    intent = F.when(F.col("r.signal") & F.col("c.signal"), 0.08).when(F.col("r.signal"), -0.05).otherwise(0.0)
    entity = F.when(F.col("r.academic") & F.col("c.organisation"), -C.ENTITY_PENALTY).otherwise(0.0)
    return domain, intent, entity


def _scores(mode: str) -> list[Column]:
    """Score of a pair (null where the candidate is rejected), its score without penalties, and how much of the reference is covered."""
    r, c = F.col(f"r.tokens_{mode}"), F.col(f"c.tokens_{mode}")
    covered = C.coverage(r, c)
    base = F.greatest(C.overlap(r, c), covered, F.col(f"ratio_{mode}"))
    unfit = F.col("c.navigation") | (F.col("c.nonprogram") & ~(F.col("r.signal") & F.col("c.signal")))
    short = F.when(F.size(c) < 2, 0.25).otherwise(0.0) + F.when(F.col("c.n") < 14, 0.10).otherwise(0.0) + F.when((F.size(r) >= 3) & (F.size(c) == 1), 0.20).otherwise(0.0)
    # a page that reads as boilerplate loses twice, unless it is let through as a unit
    penalty = F.col("c.penalty")
    cut = base * F.when(F.col("c.nonprogram"), 1.0).otherwise(1.0 - penalty) * (1.0 - penalty) * (1.0 - F.least(F.lit(0.60), short))
    domain, intent, entity = _bonus(mode)
    bonus = domain + intent + entity
    return [
        F.when(~unfit, F.least(F.lit(1.0), cut + bonus)).alias(f"score_{mode}"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), base + bonus)).alias(f"plain_{mode}"), covered.alias(f"covered_{mode}"),
    ]


def pair_scores(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Distinct ``ref, title`` pairs with their scores in every mode.

    Sequence ratios, which need Python, are computed once per distinct pair of loose keys, of all modes together.
    """
    joined = pairs.alias("p").join(features.alias("r"), F.col("p.ref") == F.col("r.title")).join(features.alias("c"), F.col("p.title") == F.col("c.title"))
    keyed = joined.select("p.ref", "p.title", "r", "c") if "r" in joined.columns else joined.select("p.ref", "p.title", F.struct("r.*").alias("r"), F.struct("c.*").alias("c"))
    needed = reduce(DataFrame.unionAll, [keyed.select(F.col(f"r.loose_{m}").alias("x"), F.col(f"c.loose_{m}").alias("y")) for m in MODES]).distinct()
    ratios = needed.withColumn("ratio", C.sequence_ratio(F.col("x"), F.col("y")))
    for mode in MODES:
        own = ratios.select(F.col("x").alias(f"x_{mode}"), F.col("y").alias(f"y_{mode}"), F.col("ratio").alias(f"ratio_{mode}"))
        keyed = keyed.join(own, (F.col(f"r.loose_{mode}") == F.col(f"x_{mode}")) & (F.col(f"c.loose_{mode}") == F.col(f"y_{mode}")))
    subset = (F.size("r.tokens_syn") > 0) & (F.size(F.array_except("r.tokens_syn", "c.tokens_syn")) == 0)
    return keyed.select("ref", "title", subset.alias("subset"), *[s for m in MODES for s in _scores(m)])


def _eligible(black_credential: bool = False) -> Column:
    """A reference of strong intent needs a candidate that carries it."""
    out = ~F.col("r.strong") | F.col("c.strong")
    return out | (F.col("c.credential") & C.has(F.col("title"), r"\bblack\b")) if black_credential else out


def _first(value: Column, when: Column, *order: Column) -> Column:
    """``value`` of the first row, by ``order``, of those for which ``when`` holds."""
    return F.min_by(F.when(when, value), F.when(when, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])))


def _two(x: Column) -> Column:
    return F.format_string("%.2f", x)


def _by_family(bounds, fuzzy: float) -> Column:
    of_race = F.exists("ref_families", lambda f: f.isin("ethnic", "race"))
    values = [b if isinstance(b, float) else max(b[0], min(b[1], fuzzy - b[2])) for b in bounds]
    return F.when(of_race, values[0]).otherwise(values[1])


def candidate_features(candidates: DataFrame, keys: list[str], categories: bool) -> DataFrame:
    """Candidates with features of both titles, scores, and what depends on the institution's other candidates."""
    rows = candidates.where("pos is not null and ref != ''")
    titles = rows.select(F.col("ref").alias("title")).union(rows.select("title")).distinct()
    features = title_features(titles)
    pairs = pair_scores(rows.select("ref", "title").distinct(), features)
    packed = features.select(F.col("title").alias("t"), F.struct(*[c for c in features.columns if not c.startswith(("loose", "tokens_"))]).alias("f"))
    out = rows.join(packed.select(F.col("t").alias("ref"), F.col("f").alias("r")), "ref").join(packed.select(F.col("t").alias("title"), F.col("f").alias("c")), "title").join(pairs, ["ref", "title"])
    of_key, of_kind = Window.partitionBy(*keys, "c.key"), Window.partitionBy(*keys, "kind")
    out = out.withColumn("sources", F.array_sort(F.collect_set("source").over(of_key))).withColumn("kinds", F.collect_set("kind").over(of_key))
    out = out.withColumn("in_pool", (F.col("c.key") != "") & (F.row_number().over(Window.partitionBy(*keys, "kind", "c.key").orderBy("pos")) == 1))
    out = out.withColumn("first_of_title", (F.col("c.key") != "") & (F.row_number().over(Window.partitionBy(*keys, "c.key").orderBy("pos")) == 1))
    only_cv = (F.size("sources") == 1) & F.array_contains("sources", "cv")
    out = out.withColumn("only_cv", only_cv).withColumn("class", F.when(F.col("only_cv"), F.col("c.class_cv")).otherwise(F.col("c.class_any")))
    nonprogram = F.col("c.nonprogram") & ~((F.col("kind") == "signal") & F.col("r.signal") & F.col("c.signal"))
    year = F.col("c.year") & ~F.col("r.year")
    # the first filter that drops a candidate, in the order of the filters
    dropped = F.when(F.col("c.navigation"), 1).when(F.col("c.mega"), 2).when(F.col("c.boilerplate"), 3).when(year, 4).when(nonprogram, 5)
    out = out.withColumn("dropped", dropped).withColumn("usable", F.col("in_pool") & ~(F.col("c.navigation") | F.col("c.mega") | year | nonprogram))
    survivor = F.col("in_pool") & F.col("dropped").isNull() & ~F.col("only_cv")
    onsite = F.max((survivor & (F.col("kind") == "program")).cast("int")).over(Window.partitionBy(*keys)) == 1
    category = F.lit(False) if categories else (F.col("kind") == "program") & onsite & F.col("only_cv") & F.col("c.taxonomy")
    out = out.withColumn("dropped", F.coalesce("dropped", F.when(category, 6)))
    out = out.withColumn("strong_exists", F.max((F.col("usable") & (F.arrays_overlap("c.families", F.array(F.lit("black"), F.lit("africana"))) | F.col("c.strong"))).cast("int")).over(of_kind) == 1)
    out = out.withColumn("onsite_primary", F.max((F.col("usable") & (F.col("class") == "primary_academic") & ~F.col("only_cv")).cast("int")).over(of_kind) == 1)
    return out.withColumn("ref_families", F.col("r.families"))


def _tiers(categories: bool, fuzzy: float) -> list[tuple[str, Column, Column, Column]]:
    """(name, which candidates it may take, threshold, what its detail adds) of the tiers, in the order in which later ones win."""
    r, c = F.col("r.families"), F.col("c.families")
    whole = (F.size("c.tokens") >= 2) & ~F.col("c.fragment")
    black = F.array(F.lit("black"), F.lit("africana"), F.lit("african"))
    african_only = F.array_contains(c, "african") & ~F.array_contains(c, "black") & ~F.array_contains(c, "africana") & ~F.col("c.strong")
    fit = (F.col("class") == "primary_academic") | ((F.col("class") == "taxonomy") & (F.lit(categories) | ~F.col("onsite_primary")))
    rename = F.col("r.rename") & whole & fit & F.arrays_overlap(c, black) & ~(african_only & F.col("strong_exists"))
    near = F.arrays_overlap(r, c) | C.related(r, c)
    credential = _eligible(black_credential=True) & F.col("c.credential") & (F.size("r.tokens") >= 2) & (F.size("c.tokens") >= 2) & near
    not_category = F.lit(categories) | ~((F.col("source") == "cv") & F.col("c.taxonomy"))
    alike = (F.col("r.credential") == F.col("c.credential")) & not_category & _eligible()
    family = F.arrays_overlap(r, F.array(*map(F.lit, ("ethnic", "race", "black", "africana")))) & alike & whole & F.arrays_overlap(r, c) & (F.col("c.anchor") != "")
    intent = ~(F.col("r.signal") & (F.col("kind") == "signal") & ~F.col("c.signal"))
    backstop = (F.size(r) > 0) & alike & (F.size("c.tokens") >= 2) & intent & near

    def shown(a: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(a), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))

    both = F.concat(F.lit("fam_ref="), shown(r), F.lit(" fam_cand="), shown(c))
    return [
        ("rename_family_rescue", rename, F.lit(RENAME_THRESHOLD), F.concat(both, F.lit(" cls="), F.col("class"), F.lit(" african_only="), african_only.cast("int").cast("string"))),
        ("related_credential", credential, _by_family(CREDENTIAL_THRESHOLDS, fuzzy), both),
        ("family_rescue", family, _by_family(FAMILY_THRESHOLDS, fuzzy), F.concat(F.lit("anchor="), F.col("c.anchor"), F.lit(" "), both, F.lit(" fam_overlap="), shown(F.array_intersect(r, c)))),
        ("related_domain_backstop", backstop, _by_family(BACKSTOP_THRESHOLDS, fuzzy), both),
    ]


FILTERS = ("nav_prefix", "mega_string", "boilerplate_drop", "year_token", "nonprogram", "cv_taxonomy_backstop", "strong_ref_gate")


def _matching(fuzzy: float) -> Column:
    """The strict keys of candidates that match their reference in some mode: all equal ones, and the best of each mode and kind."""
    nonprogram = F.col("c.nonprogram") & ~((F.col("kind") == "signal") & F.col("r.signal") & F.col("c.signal"))
    may = F.col("in_pool") & ~(F.col("c.mega") | (F.col("c.year") & ~F.col("r.year")) | nonprogram)
    exact = F.collect_set(F.when(may & ((F.col("c.key") == F.col("r.key")) | (F.col("c.bare_key") == F.col("r.bare_key"))), F.col("c.key")))
    best = [_first(F.col("c.key"), may & (F.col("kind") == kind) & (F.col(f"score_{m}") >= fuzzy) & (F.col(f"score_{m}") > 0), -F.col(f"score_{m}"), F.col("pos")) for m in MODES for kind in ("program", "signal")]
    return F.array_compact(F.array_union(exact, F.array(*best)))


def _steps(features: DataFrame, keys: list[str], fuzzy: float, categories: bool) -> DataFrame:
    """One row per institution: for every step of the ladder, every tier and every class its candidate."""
    pick = F.struct("title", F.col("c.key").alias("key"), "sources", "kinds")
    aggregates = []
    for preferred in (True, False):
        kind = (F.col("kind") == F.when(F.col("r.signal"), "signal").otherwise("program")) == F.lit(preferred)
        side = "1" if preferred else "2"
        for level, mode in LEVELS:
            strict = level.startswith("strict")
            gone = F.col("dropped") if strict else F.coalesce("dropped", F.when(~_eligible(), 7))
            left = F.col("in_pool") & kind & gone.isNull()
            score, plain = F.col(f"score_{mode}"), F.col(f"plain_{mode}")
            if strict:
                same = F.col("c.key") == F.col("r.key") if mode == "raw" else F.col("c.bare_key") == F.col("r.bare_key")
                best = _first(F.struct(pick.alias("p"), F.lit(1.0).alias("score"), F.lit(False).alias("fragment")), left & same, -F.col("pos"))
            else:
                best = _first(F.struct(pick.alias("p"), score.alias("score"), F.col("c.fragment").alias("fragment")), left & (score > 0), -score, F.col("pos"))
            out = F.col("in_pool") & kind & gone.isNotNull() & (plain > 0)
            reason = F.get(F.array(*map(F.lit, FILTERS)), gone - 1)
            rejected = _first(F.struct(F.col("title"), plain.alias("score"), reason.alias("reason")), out, -plain, gone, F.col("pos"))
            aggregates += [best.alias(f"{level}_{side}"), rejected.alias(f"{level}_{side}_out"), F.max(left.cast("int")).alias(f"{level}_{side}_any")]
        for name, may, threshold, note in _tiers(categories, fuzzy):
            value = F.struct(pick.alias("p"), F.col("score_syn").alias("score"), threshold.alias("threshold"), note.alias("note"))
            aggregates.append(_first(value, F.col("usable") & kind & may & (F.col("score_syn") > 0), -F.col("score_syn"), F.col("pos")).alias(f"{name}_{side}"))
    # winners by class: score, then whether the reference's tokens are all there, coverage, length
    win = F.coalesce("score_syn", F.lit(0.0))
    stands = F.col("first_of_title") & ~(F.col("c.navigation") | F.col("c.mega") | (F.col("c.year") & ~F.col("r.year")) | F.col("c.fragment")) & _eligible()
    onsite = F.arrays_overlap("sources", F.array(F.lit("crawl"), F.lit("signal")))
    coverage = F.when(F.col("score_syn").isNull(), 0.0).otherwise(F.col("covered_syn"))
    subset = F.when(F.col("score_syn").isNull(), False).otherwise(F.col("subset"))
    order = (-win, (~subset).cast("int"), -coverage, F.col("c.n"), F.col("pos"))
    value = F.struct(pick.alias("p"), win.alias("score"))
    for name, rule, prefers in (("primary_academic", win >= fuzzy, True), ("secondary_org", win > 0, True), ("taxonomy", win > 0, False), ("any", win > 0, True)):
        of_class = stands & rule if name == "any" else stands & rule & (F.col("class") == name)
        aggregates.append(_first(value, of_class, *(((~onsite).cast("int"), *order) if prefers else order)).alias(f"win_{name}"))
    aggregates.append(_matching(fuzzy).alias("matched"))
    return features.groupBy(*keys, "ref", F.col("r.signal").alias("ref_signal"), F.col("r.key").alias("ref_key")).agg(*aggregates)


def _source(sources: Column) -> Column:
    crawl, cv = F.array_contains(sources, "crawl"), F.array_contains(sources, "cv")
    return F.when(crawl & cv, "both").when(crawl, "crawl").when(cv, "cv").when(F.array_contains(sources, "signal"), "signal").otherwise(F.coalesce(F.get(sources, F.lit(0)), F.lit("unknown")))


_CHOICE = "struct<title:string,key:string,source:string,kind:string,level:string,score:double,detail:string>"


def _choice(found: Column, level: str, signal_first: Column, detail: Column) -> Column:
    kinds = found["p"]["kinds"]
    has_signal = F.array_contains(kinds, "signal")
    kind = F.when(signal_first & has_signal, "signal").when(has_signal & ~F.array_contains(kinds, "program"), "signal").otherwise("program")
    chosen = F.struct(found["p"]["title"].alias("title"), found["p"]["key"].alias("key"), _source(found["p"]["sources"]).alias("source"), kind.alias("kind"), F.lit(level).alias("level"), found["score"].alias("score"), detail.alias("detail"))
    return F.when(found.isNotNull(), chosen.cast(_CHOICE))


def _pair(level: str, found: Column, sign: str = "~") -> Column:
    return F.concat(F.lit(f'{level}: ref="'), F.col("ref"), F.lit(f'" {sign} cand="'), found["p"]["title"], F.lit('"'))


def matched(candidates: DataFrame, keys: list[str], fuzzy: float = FUZZY, categories: bool = False, with_keys: bool = False) -> DataFrame:
    """``keys, ref, best_title, best_source, best_kind, match_level, match_score, detail`` for every row with a reference title.

    ``candidates`` are those of :func:`.candidates.candidate_rows`.  Later tiers replace what the ladder or
    an earlier tier chose; a winner by class replaces that if it is another title and not much worse.
    ``with_keys`` adds ``matched``, the strict keys of all candidates that match in some mode.
    """
    candidates = kept(candidates)  # read by titles, by pairs and by rows
    rows = _steps(kept(candidate_features(candidates, keys, categories)), keys, fuzzy, categories)
    ladder, notes = [], []
    for level, mode in LEVELS:
        for side in ("1", "2"):
            best, out = F.col(f"{level}_{side}"), F.col(f"{level}_{side}_out")
            signal_first = F.col("ref_signal") if side == "1" else ~F.col("ref_signal")
            strict = level.startswith("strict")
            score = F.concat(F.lit(" score="), _two(best["score"]))
            ok = best.isNotNull() if strict else best.isNotNull() & ~best["fragment"] & (best["score"] >= fuzzy)
            detail = _pair(level, best, "==") if strict else F.concat(_pair(level, best), score)
            ladder.append(F.when(ok, _choice(best, level, signal_first, detail)))
            rejected = F.concat(F.lit(f"{level}: rejected by "), out["reason"], F.lit(' filter cand="'), out["title"], F.lit('" score='), _two(out["score"]))
            note = F.when((F.col(f"{level}_{side}_any") == 0) & out.isNotNull(), F.struct(out["score"].alias("score"), rejected.alias("text")))
            if not strict:
                suppressed = F.concat(F.lit(f'{level}: suppressed fragment candidate cand="'), best["p"]["title"], F.lit('"'), score)
                below = F.concat(F.lit(f'{level}: below_threshold ref="'), F.col("ref"), F.lit('" ~ cand="'), best["p"]["title"], F.lit('"'), score)
                note = F.when(best.isNotNull() & ~ok, F.struct(best["score"].alias("score"), F.when(best["fragment"], suppressed).otherwise(below).alias("text"))).otherwise(note)
            notes.append(note)
    chosen = F.coalesce(*ladder)
    tiers = []
    for name, *_ in _tiers(categories, fuzzy):
        found = F.coalesce(*[F.when(F.col(f"{name}_{side}")["score"] >= F.col(f"{name}_{side}")["threshold"], F.col(f"{name}_{side}")) for side in ("1", "2")])
        detail = F.concat(_pair(name, found), F.lit(" score="), _two(found["score"]), F.lit(" "), found["note"])
        tiers.append(_choice(found, name, F.col("ref_signal"), detail))
    rows = rows.withColumn("chosen", F.coalesce(*reversed(tiers), chosen))
    reasons = (("win_primary_academic", "patch1:primary_academic"), ("win_secondary_org", "patch1:secondary_org"), ("win_taxonomy", "patch1:taxonomy_backstop"), ("win_any", "patch1:best_available"))
    winner = F.coalesce(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c)["p"].alias("p"), F.col(c)["score"].alias("score"), F.lit(reason).alias("reason"))) for c, reason in reasons])
    rows = rows.withColumn("winner", winner)
    w, cur = F.col("winner"), F.col("chosen")
    fresh = F.concat(F.lit("winner_override: "), w["reason"], F.lit(' | ref="'), F.col("ref"), F.lit('" ~ cand="'), w["p"]["title"], F.lit('" score='), _two(w["score"]))
    instead = F.concat(F.lit('winner_override: replaced="'), cur["title"], F.lit('" ('), cur["level"], F.lit(') -> "'), w["p"]["title"], F.lit('"; '), w["reason"], F.lit(" | score="), _two(w["score"]))
    better = (w["p"]["key"] != cur["key"]) & (w["score"] >= cur["score"] - OVERRIDE_SLACK)
    no = F.lit(False)
    final = F.when(w.isNotNull() & cur.isNull(), _choice(w, "winner_override", no, fresh)).when(w.isNotNull() & better, _choice(w, "winner_override", no, instead)).otherwise(cur)
    # of the reasons why nothing was found the best-looking, the last of equals
    said = F.filter(F.array(*[F.when(n.isNotNull(), F.struct(n["score"].alias("score"), F.lit(i).alias("i"), n["text"].alias("text"))) for i, n in enumerate(notes)]), lambda x: x.isNotNull())
    rows = rows.withColumn("final", final).withColumn("said", F.get(F.sort_array(said, asc=False), F.lit(0))["text"])
    f = F.col("final")
    found = rows.select(*keys, "matched", f["title"].alias("best_title"), f["key"].alias("best_key"), f["source"].alias("best_source"), f["kind"].alias("best_kind"), f["level"].alias("match_level"), f["score"].alias("match_score"), F.coalesce(f["detail"], "said").alias("detail"))
    every = candidates.select(*keys, "ref").distinct()
    out = every.join(found, keys, "left")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("best_title", "best_key", "best_source", "best_kind")]
    extra = ["matched"] if with_keys else []
    return out.select(*keys, "ref", *blank, F.coalesce("match_level", F.lit("NO_MATCH")).alias("match_level"), F.coalesce("match_score", F.lit(0.0)).alias("match_score"), F.coalesce("detail", F.lit("")).alias("detail"), *extra)


def _shown(titles: Column) -> Column:
    return F.array_join(F.filter(titles, lambda t: t != ""), "|")


def assembled(candidates: DataFrame, keys: list[str], fuzzy: float = FUZZY, categories: bool = False) -> DataFrame:
    """The match of every row, and what else was discovered: titles by source, all of them, and those that match in no mode."""
    candidates = kept(candidates)
    best = matched(candidates, keys, fuzzy, categories, with_keys=True)
    rows = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "title", "source", "kind"))))

    def titles(rule) -> Column:
        return distinct_by_key(F.transform(F.filter("rows", rule), lambda x: x["title"]))

    lists = candidates.groupBy(*keys).agg(rows.alias("rows"), F.first("added").alias("added"))
    def programs(source: str) -> Column:
        return titles(lambda x: (x["source"] == source) & (x["kind"] == "program"))

    lists = lists.withColumns({"crawl": programs("crawl"), "cv": programs("cv"), "signals": titles(lambda x: x["kind"] == "signal")})
    lists = lists.withColumn("every", distinct_by_key(F.concat("crawl", "cv", "signals"))).withColumn("programs", distinct_by_key(F.concat("crawl", "cv")))
    out = best.join(lists, keys)
    plain = {c: _shown(F.transform(c, lambda t: C.canonical(t))) for c in ("crawl", "cv", "signals")}
    new = F.filter("every", lambda t: ~F.array_contains(F.coalesce("matched", none()), C.strict_key(t)))
    others = F.when(F.col("best_kind") == "signal", F.filter("programs", lambda t: C.strict_key(t) != F.col("best_key"))).otherwise(none())
    return out.select(
        *keys, "ref", "best_title", "best_source", "best_kind", "match_level", "match_score", "detail", C.is_signal(F.col("ref")).cast("int").alias("is_signal_ref"), F.col("added").alias("recombined_added"),
        plain["crawl"].alias("discovered_crawl"), plain["cv"].alias("discovered_cv"), plain["signals"].alias("discovered_signals"), _shown(F.col("every")).alias("discovered_all"),
        _shown(new).alias("discovered_new_unmatched"), _shown(others).alias("discovered_new_when_best_signal"),
    )

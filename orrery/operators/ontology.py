"""Seven ontology levels for the labels of several image collections, and names from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.export import CLASS_LEVELS, canonical_class, has_any, stable_grade
from orrery.operators.lines import codes

#: Collections whose labels are the nine classes, and the levels' texts.
NINE_CLASSES = ("CRC_VAL_HE_7K", "NCT_CRC_HE_100K", "MEDMNIST_PATHMNIST")
TISSUE, EPITHELIAL, NONE = "Biological Tissue", "Epithelial", "Modifier: Not applicable"
MALIGNANT, BENIGN, IN_SITU = "Malignant/Invasive", "Normal/Benign", "Pre-Malignant/In Situ"
LEVELS = tuple(f"cluster_l{i}" for i in range(1, 8))
SUBTYPES = (("ductal", "Ductal Carcinoma"), ("lobular", "Lobular Carcinoma"), ("mucin", "Mucinous Carcinoma"), ("pap", "Papillary Carcinoma"))


def _levels(*parts: Column | str) -> Column:
    return F.array(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _epithelial(organ: Column | str, state: str, entity: Column | str, pattern: Column | str, modifier: Column | str) -> Column:
    return _levels(TISSUE, EPITHELIAL, organ, state, entity, pattern, modifier)


def lymph_node(label: Column, grade: Column) -> Column:
    hit = label.isin("1", "true", "tumor", "positive")
    return F.when(hit, _epithelial("Lymph Node", MALIGNANT, "Metastatic Carcinoma", "Pattern: Metastatic focus", grade)).otherwise(
        _epithelial("Lymph Node", BENIGN, "Normal Lymph Node Tissue", "Pattern: Lymph node parenchyma", NONE)
    )


def lung_colon(raw: Column, grade: Column) -> Column:
    """Labels <organ>__<class>; without an organ it follows from the class."""
    two = raw.contains("__")
    organ_part = F.when(two, F.trim(F.element_at(F.split(raw, "__"), 1))).otherwise(F.lit(""))
    kind = F.when(two, F.trim(F.regexp_replace(raw, "^.*?__", ""))).otherwise(raw)
    organ = F.when(organ_part.isin("0", "lung"), "Lung").when(organ_part.isin("1", "colon", "colorectal"), "Colorectal").when(kind.contains("squamous"), "Lung").when(kind.contains("colon"), "Colorectal").otherwise("Generic")
    return (
        F.when(kind.contains("squamous"), _epithelial(organ, MALIGNANT, "Squamous Cell Carcinoma", "Pattern: Squamous differentiation", grade))
        .when(kind.contains("adeno"), _epithelial(organ, MALIGNANT, "Adenocarcinoma", "Pattern: Gland-forming carcinoma", grade))
        .otherwise(_epithelial(organ, BENIGN, "Benign/Normal Tissue", "Pattern: Benign parenchyma", NONE))
    )


def breast_states(label: Column, grade: Column) -> Column:
    return (
        F.when(label.contains("invasive"), _epithelial("Breast", MALIGNANT, "Invasive Carcinoma", "Pattern: Invasive nests", grade))
        .when(has_any(label, ("in situ", "insitu")), _epithelial("Breast", IN_SITU, "Carcinoma in situ", "Pattern: In situ ducts", NONE))
        .when(label.contains("benign"), _epithelial("Breast", BENIGN, "Benign Breast Lesion", "Pattern: Benign glands", NONE))
        .otherwise(_epithelial("Breast", BENIGN, "Normal Breast Tissue", "Pattern: Normal ducts/lobules", NONE))
    )


def breast_subtypes(raw: Column, grade: Column) -> Column:
    """Labels breast__<group>__<subtype>__<magnification>."""
    parts = F.split(raw, "__")
    full = F.size(parts) >= 4
    part = lambda i: F.when(full, F.coalesce(F.nullif(F.try_element_at(parts, F.lit(i)), F.lit("")), F.lit("unspecified"))).otherwise(F.lit("unspecified"))
    subtype, size = part(3), F.replace(part(4), F.lit("x"), F.lit("X"))
    acquired = F.when(size.isin("unspecified", "unknown", "mag_unknown"), "Acquisition: Magnification unknown").otherwise(F.concat(F.lit("Acquisition: "), size))
    named = lambda base: F.when(subtype == "unspecified", F.concat(F.lit("Pattern: "), base)).otherwise(F.concat(F.lit("Pattern: "), base, F.lit(" ("), subtype, F.lit(")")))
    entity: Column = F.lit("Invasive Carcinoma")
    for word, name in reversed(SUBTYPES):
        entity = F.when(subtype.contains(word), name).otherwise(entity)
    benign = raw.contains("benign") & (raw.contains("__benign") | ~raw.contains("malignant"))
    return F.when(benign, _epithelial("Breast", BENIGN, "Benign Breast Lesion", named(F.lit("Benign lesion")), acquired)).otherwise(_epithelial("Breast", MALIGNANT, entity, named(entity), grade))


def oral(label: Column, grade: Column) -> Column:
    return (
        F.when(has_any(label, ("oscc", "squamous", "carcinoma")), _epithelial("Oral Cavity", MALIGNANT, "Squamous Cell Carcinoma", "Pattern: Squamous differentiation", grade))
        .when(has_any(label, ("dysplasia", "in situ")), _epithelial("Oral Cavity", IN_SITU, "Dysplasia", "Pattern: Atypical epithelium", NONE))
        .otherwise(_epithelial("Oral Cavity", BENIGN, "Normal Oral Mucosa", "Pattern: Normal squamous mucosa", NONE))
    )


def nine_classes(label: Column, grade: Column) -> Column:
    """The levels by class, from one constant map; a missing level is the grade."""
    table = F.create_map(*[x for name, levels in CLASS_LEVELS.items() for x in (F.lit(name), F.array(*[F.lit(v) for v in levels]))])
    return F.transform(F.element_at(table, canonical_class(label)), lambda v: F.coalesce(v, grade))


def with_levels(df: DataFrame, dataset_col: str = "dataset_key", label_col: str = "label", raw_col: str = "raw_label", id_col: str = "item_id") -> DataFrame:
    """df with cluster_l1 to cluster_l7 by the rules of each row's collection, and ontology_path; unknown collections get the label itself as entity."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), r"[_\s]+", " "))
    label, raw = plain(label_col), F.lower(F.coalesce(F.col(raw_col).cast("string"), F.lit("")))
    grade, key = stable_grade(F.col(id_col)), F.col(dataset_col)
    leaf = F.initcap(F.when(label == "", "unknown").otherwise(label))
    levels = (
        F.when(key.isin(*NINE_CLASSES), nine_classes(label, grade))
        .when(key == "HF_PCAM", lymph_node(label, grade))
        .when(key == "HF_LC25000", lung_colon(raw, grade))
        .when(key == "HF_BACH", breast_states(plain(raw_col), grade))
        .when(key == "HF_BREAKHIS_RCL_7500", breast_subtypes(raw, grade))
        .when(key == "ORCA_ORAL_ANNOTATED_100", oral(plain(raw_col), grade))
        .otherwise(_levels(TISSUE, "Other Tissue", "Generic", "Unknown State", leaf, F.concat(F.lit("Pattern: "), leaf), "Modifier: Not provided"))
    )
    out = df.withColumn("__levels", levels)
    out = out.withColumns({c: F.element_at("__levels", i + 1) for i, c in enumerate(LEVELS)})
    return out.withColumn("ontology_path", F.array_join("__levels", " > ")).drop("__levels")


def keyed(df: DataFrame) -> DataFrame:
    """df with cluster_id (replaced): the place of its ontology path among the sorted paths."""
    return df.drop("cluster_id").join(codes(df, "ontology_path", "cluster_id", "int"), "ontology_path")


def majority_names(df: DataFrame, mixed: float = 0.55, noise: int = -1) -> DataFrame:
    """cluster_id, cluster_name: "organ — entity (state)" by majority; below a share of `mixed` the two largest entities are named. Ties go by name."""

    def top(level: str, k: int) -> DataFrame:
        n = df.groupBy("cluster_id", F.col(level).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("cluster_id")
        return n.withColumns({"r": F.row_number().over(w.orderBy(F.desc("n"), "v")), "share": F.col("n") / F.sum("n").over(w)}).filter(F.col("r") <= k)

    entity = top("cluster_l5", 2).groupBy("cluster_id").agg(F.max(F.when(F.col("r") == 1, F.col("v"))).alias("e"), F.max(F.when(F.col("r") == 1, F.col("share"))).alias("share"), F.transform(F.sort_array(F.collect_list(F.struct("r", "v"))), lambda x: x["v"]).alias("two"))
    organ, state = (top(c, 1).select("cluster_id", F.col("v").alias(a)) for c, a in (("cluster_l3", "o"), ("cluster_l4", "s")))
    both = entity.join(organ, "cluster_id").join(state, "cluster_id")
    one = F.concat("o", F.lit(" — "), "e", F.lit(" ("), "s", F.lit(")"))
    many = F.concat("o", F.lit(" — Mixed ("), "s", F.lit("): "), F.array_join("two", ", "))
    name = F.when(F.col("cluster_id") == noise, "Noise / Outliers").when((F.size("two") > 1) & (F.col("share") < mixed), many).otherwise(one)
    return both.select("cluster_id", name.alias("cluster_name"))

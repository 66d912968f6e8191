"""Names, labels and schemas that results depend on."""

from pyspark.sql import types as T

# Names that cleaning must leave untouched.
EXEMPT_NAMES = (
    "5-(9-Isopropyl-8-methyl-2-morpholino-9H-purin-6-yl)pyrimidin-2-amine",
    "2-(4-Amino-5-iodo-7-pyrrolo[2,3-d]pyrimidinyl)-5-(hydroxymethyl)oxolane-3,4-diol",
)

# Whole-name aliases, old name -> new name.
NAME_ALIASES = {
    "O-Demethylated Adapalene": "O-Desmethyl Adapalene",
    "IN1451": "2-(4-Amino-5-iodo-7-pyrrolo[2,3-d]pyrimidinyl)-5-(hydroxymethyl)oxolane-3,4-diol",
}

# Characters that end the useful part of a name, in cutting order.
NAME_CUTS = ("(", ";")

# The 29 characters Python's str.strip() removes, as a regex class body.
STRIP_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Text tokens that mean "missing" in a CSV field.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Identifying feature columns.
FEATURE_COLUMNS = ("cell_type", "sm_name", "sm_lincs_id", "SMILES", "control")

# Ordinal code of each cell-type label.
CELL_TYPE_CODES = {
    "B cells": 0,
    "Myeloid cells": 1,
    "NK cells": 2,
    "T cells CD4+": 3,
    "T cells CD8+": 4,
    "T regulatory cells": 5,
}

# Cell-type groups used for the group-aware hold-out.
MAJORITY_CELL_TYPES = ("T cells CD4+", "NK cells", "T cells CD8+", "T regulatory cells")
MINORITY_CELL_TYPES = ("B cells", "Myeloid cells")

# Compound property names, in table order, with their types.
COMPOUND_PROPERTIES = T.StructType([
    T.StructField("MolecularWeight", T.DoubleType()),
    T.StructField("XLogP3-AA", T.DoubleType()),
    T.StructField("HydrogenBondDonorCount", T.IntegerType()),
    T.StructField("HydrogenBondAcceptorCount", T.IntegerType()),
    T.StructField("RotatableBondCount", T.IntegerType()),
    T.StructField("ExactMass", T.DoubleType()),
    T.StructField("MonoisotopicMass", T.DoubleType()),
    T.StructField("TopologicalPolarSurfaceArea", T.DoubleType()),
    T.StructField("HeavyAtomCount", T.IntegerType()),
    T.StructField("FormalCharge", T.IntegerType()),
    T.StructField("Complexity", T.DoubleType()),
    T.StructField("IsotopeAtomCount", T.IntegerType()),
    T.StructField("CovalentlyBondedUnitCount", T.IntegerType()),
])

PROPERTY_TABLE = T.StructType([T.StructField("sm_name", T.StringType()), *COMPOUND_PROPERTIES.fields])

# The statistics taken of each measurement table, first and second level.
OBSERVATION_STATS = {"count": ("mean", "sum"), "normalized_count": ("mean", "sum")}
GROUP_STATS = {
    "count_mean": "mean",
    "count_sum": "sum",
    "normalized_count_mean": "mean",
    "normalized_count_sum": "sum",
}

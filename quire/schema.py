"""Constants, thresholds and schemas that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the scoring policy.
POLICY_VERSION = "1.0"
MARKER = "[UNREADABLE]"
LEVELS = ("strict", "diacritic_insensitive", "skeleton")
DIMENSIONS = ("font", "distortion", "source")
DIMENSION_COLUMNS = {"font": "fonts", "distortion": "distortions", "source": "source"}
KINDS = ("synthetic", "scan", "probe")
OUTCOMES = ("scored", "false_refusal", "correct_refusal", "hallucination")
PROBE_OUTCOMES = ("correct_refusal", "hallucination")
FLAGS = ("empty_prediction", "repetition", "runaway_length")
SPARSE = "__sparse__"
GOLD_SPLIT = "gold_scans"
PRIMARY_SPLIT = "synthetic_heldout"

# Marks that the second level drops, blocks whose letters carry marks, and letters and digits that the third folds.
DIACRITICS = ((0x064B, 0x065F), (0x0670, 0x0670), (0x06D6, 0x06DC), (0x06DF, 0x06E4), (0x06E7, 0x06E8), (0x06EA, 0x06ED), (0x08D3, 0x08E1), (0x08E3, 0x08FF))
ARABIC_BLOCKS = ((0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))
TATWEEL = 0x0640
LETTER_FOLD = {0x0622: 0x0627, 0x0623: 0x0627, 0x0625: 0x0627, 0x0671: 0x0627, 0x0672: 0x0627, 0x0673: 0x0627, 0x0675: 0x0627, 0x0624: 0x0648, 0x0626: 0x064A, 0x0621: None, 0x0649: 0x064A, 0x06CC: 0x064A, 0x06A9: 0x0643, 0x0629: 0x0647, 0x06C0: 0x0647, 0x06C1: 0x0647, 0x06C2: 0x0647}
DIGIT_ZEROS = (0x0660, 0x06F0)

# Thresholds, by their names in a settings file.
THRESHOLDS = {
    "runaway_length_ratio": 2.0,
    "runaway_min_char_excess": 100,
    "repetition_min_line_len": 10,
    "repetition_min_occurrences": 5,
    "repetition_min_char_share": 0.30,
    "line_match_min_similarity": 0.5,
    "min_pages_per_breakdown_row": 5,
    "promote_min_cer_improvement_pp": 0.5,
    "reject_on_any_gold_regression": True,
    "reject_hallucination_worsening_pp": 1.0,
    "reject_false_refusal_worsening_pp": 1.0,
    "bootstrap_resamples": 10000,
    "bootstrap_seed": 20260916,
}
CONFIDENCE = 0.95

STRINGS = T.ArrayType(T.StringType(), False)

MANIFEST = T.StructType(
    [
        T.StructField("page_id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("reference_text", T.StringType()),
        T.StructField("reference_path", T.StringType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("fonts", STRINGS),
        T.StructField("distortions", STRINGS),
        T.StructField("source", T.StringType()),
        T.StructField("is_augmented", T.BooleanType()),
    ]
)

LEVEL = T.StructType(
    [T.StructField("cer", T.DoubleType()), T.StructField("wer", T.DoubleType()), T.StructField("exact_match", T.BooleanType())]
    + [T.StructField(n, T.IntegerType()) for n in ("char_edits", "ref_chars", "word_edits", "ref_words")]
)

ORDER = T.StructType(
    [T.StructField("order_corrected_cer", T.DoubleType()), T.StructField("reading_order_accuracy", T.DoubleType())]
    + [T.StructField(n, T.IntegerType()) for n in ("matched_lines", "ref_lines", "pred_lines")]
)

#: A page as a run directory holds it.
PAGE = T.StructType(
    [
        T.StructField("page_id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("fonts", STRINGS),
        T.StructField("distortions", STRINGS),
        T.StructField("source", T.StringType()),
        T.StructField("is_augmented", T.BooleanType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("flags", STRINGS),
        T.StructField("length_ratio", T.DoubleType()),
        T.StructField("metrics", T.StructType([T.StructField(n, LEVEL) for n in LEVELS])),
        T.StructField("order", ORDER),
    ]
)

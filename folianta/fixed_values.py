"""Values that results depend on, kept as plain text in one place.

Every one of them is only a default: each operator takes its own lists, patterns,
sizes and templates as arguments.
"""

# --- fixed values: record harvesting -----------------------------------------------

DUBLIN_CORE_FIELDS = [
    "title", "creator", "subject", "description", "publisher",
    "contributor", "date", "type", "format", "identifier",
    "source", "language", "relation", "coverage", "rights",
]
NAMESPACES = {
    "oai": "http://www.openarchives.org/OAI/2.0/",
    "oai_dc": "http://www.openarchives.org/OAI/2.0/oai_dc/",
    "dc": "http://purl.org/dc/elements/1.1/",
}
META_PREFIXES = ["DC.", "DCTERMS."]
ITEM_LINK_NEEDLE = "/handle/"
LINK_DENY_LIST = ["discover", "browse", "community-list", "submit"]
RESULTS_PER_PAGE = 100

# --- fixed values: wide export -----------------------------------------------------

TITLE_PATTERNS = ["dc.title["]
ABSTRACT_PATTERNS = ["abstract["]
SUBJECT_PATTERNS = ["subject[", "subject.ford[", "subject.materias["]
TYPE_PATTERNS = ["type[", "subtype["]
LANGUAGE_PRIORITY = ["[es]", "[en]", "[pt]", "[fr]", "[de]", "[it]"]
VALUE_SEPARATOR = "||"
# what pandas reads as a missing cell by default
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: corpus preparation ----------------------------------------------

SUBJECT_REGEX = (
    "informática|computación|software|sistemas de información|computer science"
)
MINORITY_CLASSES = [
    "Imagen en movimiento", "Reporte", "Documento institucional",
    "Publicacion seriada", "Proyecto", "Imagen fija", "Conjunto de datos", "Audio",
]
COLLAPSED_CLASS = "Otro"
UNKNOWN_CLASS = "Desconocido"
MIN_CLASS_ROWS = 10
MIN_HELDOUT_ROWS = 2
HELDOUT_SHARE = 0.30
TEST_SHARE = 0.50

# --- fixed values: evaluation ------------------------------------------------------

# the order decides which class wins when a text contains several
CLASS_DOMAIN = [
    "objeto de conferencia", "objeto de aprendizaje", "articulo", "tesis",
    "libro", "otro",
]
UNCLASSIFIED = "sin_clasificar"
PROMPT_INSTRUCTIONS = (
    "Eres un clasificador automático de documentos académicos. "
    "Tu única tarea es asignar la categoría correcta a los registros bibliográficos provistos.\n"
    "Regla estricta: Debes responder ÚNICAMENTE con el nombre exacto de la categoría. "
    "No incluyas explicaciones, puntuación adicional ni texto conversacional.\n"
    "Categorías válidas: Articulo, Objeto de conferencia, Tesis, Libro, Otro, Objeto de aprendizaje."
)
PROMPT_REQUEST = "Clasifica el siguiente registro:\n"
PROMPT_TITLE_TAG = "titulo"
PROMPT_ABSTRACT_TAG = "resumen"
TEXT_START = "<|begin_of_text|>"
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>"
TURN_END = "<|eot_id|>"
CONTROL_TOKENS = [TEXT_START, HEADER_START, HEADER_END, TURN_END]
INFERENCE_BATCH = 16
MAX_TOKENS = 512

# --- fixed values: subword vocabularies --------------------------------------------

SPECIAL_TOKENS = ["[UNK]", "[PAD]", "[CLS]", "[SEP]", "[MASK]"]
CONTINUATION_PREFIX = "##"

# --- fixed values: runs ------------------------------------------------------------

ADAPTER_METHODS = ["lora", "dora", "qlora", "qdora"]
PROJECTION_METHODS = ["galore", "galore_rsvd"]
CONFIG_KEYS = ["method", "lora_r", "galore_rank", "update_proj_gap", "target_modules"]
TRAIN_METRICS = [
    "train_time_hours", "base_memory_gb", "peak_memory_gb", "peak_reserved_memory_gb",
    "trainable_parameters", "total_parameters", "trainable_percent",
    "train_samples_per_second", "train_steps_per_second", "final_train_loss",
    "final_eval_loss", "svd_total_seconds", "svd_call_count", "svd_avg_ms_per_call",
]
EVAL_METRICS = [
    "accuracy", "macro_f1", "exact_match", "inference_time_seconds",
    "samples_per_second", "tokens_per_second",
]
CLASS_METRICS = ["f1_score", "exact_match", "precision", "recall", "support"]
EPOCH_METRICS = [
    "loss", "grad_norm", "learning_rate", "entropy", "num_tokens",
    "mean_token_accuracy",
]
GRID_RANKS = [8, 16, 32, 64, 128]
GRID_SUBSPACE = [("galore", 128, 500), ("galore_rsvd", 128, 200), ("galore_rsvd", 128, 500)]

# --- fixed values: characters ------------------------------------------------------

# The 29 code points that count as white space. Java's own \s is ASCII only, so the set
# is written out, in a spelling that java.util.regex and RE2 share.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# what the subword tokenizers' splitter leaves out: the separators \x1c-\x1f
TOKEN_GAPS = (
    r"\t-\r\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# letters, marks, digits, connectors, joiners and circled or squared letters
WORD_CHARS = (
    r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}\x{24b6}-\x{24e9}"
    r"\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
)
# \x80-\x9f stay: the normalizer's regular expressions do not match them as characters
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

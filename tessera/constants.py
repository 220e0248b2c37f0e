"""Values that must equal the reference's for results to agree.

FIXED VALUES (kept verbatim, in the reference's natural order).
"""

# --- FIXED VALUES: special tokens added to the tokenizer, in order --------
SPECIAL_TOKENS = ["</s>", "<s>", "<unk>", "<pad>", "<mask>"]
UNK_ID = 2
PAD_ID = 3

# --- FIXED VALUES: entity replacements applied to the article payload -----
TAG_ENTITIES = [("&gt;", ">"), ("&lt;", "<")]

# --- FIXED VALUES: natural-language-inference label words -> ids ----------
NLI_LABELS = ["entailment", "neutral", "contradiction"]

# --- FIXED VALUES: task -> (first text column, second text column) --------
#     and task -> metric configuration.  A task without a loader and a
#     metric ("wsd") is not registered (see README, D10).
TASK_KEYS = {
    "cls": ("sentence", None),
    "pawsx": ("sentence1", "sentence2"),
    "xnli": ("premise", "hypothesis"),
}
TASK_METRIC = {
    "cls": "sst2",
    "pawsx": "mrpc",
    "xnli": "mnli",
}
# Tasks that run one seed only.
SINGLE_SEED_TASKS = ["pawsx", "xnli", "wsd"]

# --- FIXED VALUES: metric configurations accepted by the metric dispatch --
METRIC_CONFIGS = ["sst2", "mnli", "mnli_mismatched", "mnli_matched", "cola", "stsb",
                  "mrpc", "qqp", "qnli", "rte", "wnli", "hans"]
CONFIG_METRICS = {
    "cola": ["matthews_correlation"],
    "stsb": ["pearson", "spearmanr"],
    "mrpc": ["accuracy", "f1"],
    "qqp": ["accuracy", "f1"],
}
ACCURACY_CONFIGS = ["sst2", "mnli", "mnli_mismatched", "mnli_matched", "qnli", "rte",
                    "wnli", "hans"]

# --- FIXED VALUES: defaults of the reference's scripts ---------------------
N_VALID = 60
N_TEST = 60
TOP_K = 50
TOP_P = 0.95
GEN_MAX_LENGTH = 200
PACK_MAX_TOKENS = 1024
NOT_SCORED = -100

# --- FIXED VALUES: index-page patterns (section year anchor, entry anchor) -
SECTION_PATTERN = r'<span class.*? id.*?>(\d{4})</span>'
ENTRY_PATTERN = r'<li>\d+.*?<a .*?href="/wiki/(.*?)" title="(.*?)"'

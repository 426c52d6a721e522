"""Values that must be equal to the curated dataset's definition.

Everything under "FIXED VALUES" is data, not logic: instruction templates, the
low-quality openings of a docstring, README template markers, the validation
schema bounds and the processor names.  They are stated in their natural order
so that a reader can check them line by line against the dataset specification.
Values marked [decision] are ours where the specification is silent.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the dataset specification)
# ---------------------------------------------------------------------------

# Instruction templates per task type.
INSTRUCTION_TEMPLATES: dict[str, list[str]] = {
    "function_doc": [
        "Generate documentation for this function.",
        "Write a concise docstring for this code.",
        "Document this function with its parameters and return value.",
        "Write a brief description of what this code does.",
        "Create documentation for the following code.",
        "Add a docstring to this function.",
        "Write the documentation for this code snippet.",
        "What does this function do?",
        "Can you explain this code?",
        "What is the purpose of this function?",
        "Describe what this code accomplishes.",
        "Summarize this function in one sentence.",
        "Write a one-line description for this function.",
        "Explain the inputs and outputs of this function.",
        "Document this code following best practices.",
        "Write a clear and concise docstring.",
        "As a developer, write documentation for this code.",
        "Help me understand what this function does.",
        "Generate a helpful docstring for other developers.",
        "Write documentation that explains the purpose and usage.",
        "Docstring for this code:",
        "Document this code:",
        "Explain this code briefly:",
        "What does this code do?",
        "Write comprehensive documentation including parameters, return values, and any exceptions.",
        "Create a detailed docstring with examples if applicable.",
    ],
    "readme_gen": [
        "Generate a README for this project based on its structure.",
        "Write documentation for this codebase.",
        "Create a concise project README from this code structure.",
        "Write a project overview based on this file structure.",
        "Generate project documentation.",
    ],
    "code_explain": [
        "Explain what this code does concisely.",
        "Summarize the purpose of this code.",
        "Describe this code's functionality.",
        "What is this code doing?",
        "Break down this code for me.",
        "Explain the logic in this code.",
    ],
}

# Docstrings whose stripped text starts with one of these (case-insensitive)
# are rejected; "..." must be the whole stripped text.
LOW_QUALITY_OPENINGS: list[str] = [
    "TODO",
    "FIXME",
    "XXX",
    "...",  # whole text only
    "Add description",
    "No description",
    "Undocumented",
    "@param",
    "@return",
]

# Case-sensitive README markers of template-generated content.
README_TEMPLATE_MARKERS: list[str] = [
    "<!-- PROJECT SHIELDS -->",
    "{{cookiecutter",
    "REPLACE_ME",
    "TODO: Add",
]

# Constant output of whole-file examples.
FILE_EXAMPLE_OUTPUT = "Analyze the code structure and provide documentation."

# Fixed instruction of the documented pair conversion.
DOCUMENTED_PAIR_INSTRUCTION = "Generate documentation for this function"

# Processors of the preprocessing job: (display name, source tag), in run order.
PROCESSORS: list[tuple[str, str]] = [
    ("CodeSearchNet", "codesearchnet"),
    ("Code Docstring Corpus", "code_docstring_corpus"),
    ("Python Instructions", "python_code_instructions"),
    ("The Stack Smol", "the_stack_smol"),
]

# Raw-data sub-directories read by each processor.
RAW_DIRS: dict[str, str] = {
    "codesearchnet": "codesearchnet",
    "code_docstring_corpus": "code_docstring_corpus",
    "python_code_instructions": "python_code_instructions",
    "the_stack_smol": "the_stack_smol",
}

# Validation schema enforced by the validator: field -> (min, max) code points.
TRAINING_BOUNDS: dict[str, tuple[int, int]] = {
    "instruction": (10, 500),
    "input": (20, 10000),
    "output": (10, 5000),
}
# Alternative bounds from the data-format document.
DOCUMENTED_BOUNDS: dict[str, tuple[int, int]] = {
    "instruction": (10, 500),
    "input": (50, 8000),
    "output": (20, 4000),
}
REQUIRED_FIELDS: list[str] = ["instruction", "input", "output"]
OPTIONAL_STRING_FIELDS: list[str] = ["source", "language"]

# Defaults of the jobs' parameters.
DEFAULT_SEED = 42
DEFAULT_TRAIN_RATIO = 0.8
DEFAULT_VAL_RATIO = 0.1
DRY_RUN_LIMIT = 100
INGEST_LANGUAGES: list[str] = ["python", "javascript", "java", "go", "ruby", "php"]
SCRAPE_LANGUAGES: list[str] = ["python", "javascript", "typescript"]
SCRAPE_MIN_STARS = 500
SCRAPE_LIMIT = 100
SCRAPE_PUSHED_WITHIN_DAYS = 730
README_MIN_CHARS = 500
README_MIN_SECTIONS = 2
TREE_MAX_DEPTH = 2
PREVIEW_CHARS = {"instruction": 60, "input": 100, "output": 100}
DRY_RUN_PREVIEW_CHARS = 600

# Token limits and quality thresholds from the pipeline configuration.
TOKEN_LIMITS = {"input": (50, 4000), "output": (20, 2000)}
MAX_BOILERPLATE_RATIO = 0.5
MAX_NON_ASCII_RATIO = 0.2
TEMPLATE_PLACEHOLDERS: list[str] = ["{{", "}}", "%s"]
GENERIC_PHRASES: list[str] = ["TODO", "FIXME", "Add description"]

# Filler openings to avoid in generated documentation.
FILLER_OPENINGS: list[str] = ["This is a", "The purpose of", "This function does"]

# ---------------------------------------------------------------------------
# [decision] parameters where the specification is silent
# ---------------------------------------------------------------------------

# Key files of a repository tree (package/config manifests and entry points).
KEY_FILE_NAMES: list[str] = [
    "package.json",
    "pyproject.toml",
    "setup.py",
    "setup.cfg",
    "requirements.txt",
    "Cargo.toml",
    "go.mod",
    "pom.xml",
    "build.gradle",
    "Gemfile",
    "composer.json",
    "Makefile",
    "Dockerfile",
    "main.py",
    "__main__.py",
    "app.py",
    "index.js",
    "index.ts",
    "main.go",
    "main.rs",
    "lib.rs",
]

# Key files in a repository prompt: code points of each, files of each repository
# (nearest the root first), and the language of a fence by file extension.
KEY_FILE_CHARS = 2000
KEY_FILE_LIMIT = 50
FENCE_LANGUAGES: dict[str, str] = {
    "json": "json", "toml": "toml", "py": "python", "js": "javascript", "ts": "typescript",
    "go": "go", "rs": "rust", "xml": "xml", "cfg": "ini", "gradle": "groovy",
}

# License families: (license name, family, case-insensitive pattern).
LICENSE_RULES: list[tuple[str, str, str]] = [
    ("MIT", "permissive", r"\bMIT License\b|\bLicensed under the MIT\b|\bMIT licen[cs]e"),
    ("Apache-2.0", "permissive", r"\bApache License,? (Version )?2\.0\b|\bApache 2\.0\b|\bApache-2\.0\b"),
    ("BSD", "permissive", r"\bBSD (2|3)-Clause\b|\bBSD licen[cs]e\b"),
    ("GPL-3.0", "copyleft", r"\bGNU General Public License\b|\bGPL(v|-| )?3(\.0)?\b"),
    ("CC-BY-NC-4.0", "non-commercial", r"\bCC BY-NC 4\.0\b|\bCreative Commons Attribution-NonCommercial\b"),
]

# Stopwords used to score the language of a text (short, frequent, unambiguous).
STOPWORDS: dict[str, list[str]] = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "it", "with", "for", "this", "was", "are", "be", "as"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "von", "mit", "sich", "auf", "für"],
    "fr": ["le", "la", "les", "et", "des", "du", "un", "une", "est", "dans", "que", "qui", "pour", "sur", "avec"],
    "es": ["el", "los", "las", "y", "de", "en", "que", "es", "por", "con", "una", "para", "del", "se", "lo"],
}

# Length buckets of the stratified split (characters of output).
LENGTH_BUCKETS = (500, 2000)

# A README is generated when at least so many READMEs share its skeleton, which has at
# least so many headings (shorter skeletons recur by chance).
GENERATED_MIN_READMES = 5
GENERATED_MIN_HEADINGS = 3

# Near-duplicate parameters.
SHINGLE_WORDS = 3
JACCARD_NUM, JACCARD_DEN = 7, 10  # similarity >= 0.7, compared in integers

# Lines shared by at least this many documents count as boilerplate.
BOILERPLATE_MIN_DOCS = 10

# Quality-score weights: High = 2, Medium = 1.
QUALITY_WEIGHTS = {"alignment": 2, "conciseness": 2, "license": 2, "recency": 1, "diversity": 1}

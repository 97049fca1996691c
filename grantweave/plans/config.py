"""Settings that affect data. Paths and processes are the caller's business."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# The expected source folders.
SOURCES = ("ClinicalStudies", "Patents", "PRJ", "PRJABS", "PUB", "PUBLINK")

# Column names that differ between sources and their common name.
RENAME_COLUMNS = {
    "CORE_PROJECT_NUM": "PROJECT_NUMBER",
    "PROJECT_ID": "PROJECT_NUMBER",
    "Core Project Number": "PROJECT_NUMBER",
}

# Outcome count column, source, item column.
OUTCOMES = (
    ("publication_count", "PUBLINK", "PMID"),
    ("patent_count", "Patents", "PATENT_ID"),
    ("clinical_study_count", "ClinicalStudies", "ClinicalTrials.gov ID"),
)

# The default keyword lists.
TREATMENTS = (
    "CRISPR",
    "gene editing",
    "genome editing",
    "ASO",
    "prime editor",
    "base editor",
    "gene therapy",
    "gene editor",
    "antisense oligonucleotide",
    "cas9",
)
DISEASES = (
    "Abetalipoproteinemia",
    "Acute Hepatic Porphyria",
    "Aicardi Syndrome",
    "Alagille Syndrome",
    "Alkaptonuria",
    "Alström Syndrome",
    "Amyotrophic Lateral Sclerosis",
    "Angelman Syndrome",
    "Bardet-Biedl Syndrome",
    "Batten Disease",
    "Beckwith-Wiedemann Syndrome",
    "Brugada Syndrome",
    "CADASIL",
    "Chronic Granulomatous Disease",
    "Cri-du-chat Syndrome",
    "Cystic Fibrosis",
    "Duchenne Muscular Dystrophy",
    "Ehlers-Danlos Syndrome",
    "Epidermolysis Bullosa",
    "Fabry Disease",
    "Fragile X Syndrome",
    "Friedreich's Ataxia",
    "Gaucher Disease",
    "Haemophilia",
    "Hereditary Angioedema",
    "Huntington's Disease",
    "Hurler Syndrome",
    "Incontinentia Pigmenti",
    "inherited",
    "Jumping Frenchmen of Maine",
    "Kabuki Syndrome",
    "Langerhans Cell Histiocytosis",
    "Leigh Syndrome",
    "Lesch-Nyhan Syndrome",
    "Marfan Syndrome",
    "monogenetic",
    "Moyamoya Disease",
    "Multiple System Atrophy",
    "Neurofibromatosis",
    "Niemann-Pick Disease",
    "Ornithine Transcarbamylase Deficiency",
    "orphan disease",
    "Parry-Romberg Syndrome",
    "Phenylketonuria",
    "Pompe Disease",
    "Prader-Willi Syndrome",
    "Primary Ciliary Dyskinesia",
    "Progeria",
    "Pseudoxanthoma Elasticum",
    "rare disease",
    "Rett Syndrome",
    "Sickle Cell Disease",
    "Spinal Muscular Atrophy",
    "Sturge-Weber Syndrome",
    "Tay-Sachs Disease",
    "Von Hippel-Lindau Disease",
    "Wilson's Disease",
    "Wolfram Syndrome",
)

# Text columns searched for keywords, and the columns of the training table.
TEXT_COLUMNS = ("PROJECT_TITLE", "PROJECT_TERMS", "PHR", "ABSTRACT_TEXT")
ML_COLUMNS = (
    "APPLICATION_ID",
    "PHR",
    "PROJECT_TERMS",
    "PROJECT_TITLE",
    "ABSTRACT_TEXT",
    "total_count",
    "total_unique_count",
    "flagged",
)

# Column spellings of the exported CSV files.
EXPORT_NAMES = {
    "publication_count": "publication count",
    "patent_count": "patent count",
    "clinical_study_count": "clinical study count",
    "total_count": "total count",
    "total_unique_count": "total unique count",
}


@dataclass(frozen=True)
class StageConfig:
    sources: Sequence[str] = SOURCES
    rename_columns: Mapping[str, str] = field(default_factory=lambda: dict(RENAME_COLUMNS))
    force_append: bool = True
    #: None finds out per file whether records span lines
    multi_line: bool | None = None
    #: give columns the narrowest type that all files agree on, after they have been appended as text
    infer_types: bool = False
    #: normalise the project table's own number before outcome counts are joined
    normalize_left: bool = True
    #: let null application ids meet each other
    null_safe: bool = False
    keywords: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"treatment": TREATMENTS, "disease": DISEASES}
    )
    remove_stopwords: bool = True
    fold_text: bool = False
    text_columns: Sequence[str] = TEXT_COLUMNS
    ml_columns: Sequence[str] = ML_COLUMNS
    cutoff_value: int = 1
    export_drop_output: bool = True


DEFAULT_CONFIG = StageConfig()

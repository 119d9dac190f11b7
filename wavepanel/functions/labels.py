"""Code -> text labels of categorical answers, and variable labels as
column metadata.

Labels are applied with a literal map (``element_at``), which stays inside
generated code; ``label_table`` gives the same content as a small
(domain, code, label) DataFrame for joins or for a catalogue of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Answer labels of the survey's coded questions.
CODE_LABELS: dict[str, dict[int, str]] = {
    "wellbeing": {
        -1: "NA",
        1: "Much worse off",
        2: "Somewhat worse off",
        3: "About the same",
        4: "Somewhat better off",
        5: "Much better off",
    },
    "employment_status": {
        1: "Working full-time (for someone or self-employed)",
        2: "Working part-time (for someone or self-employed)",
        3: "Not working, but would like to work",
        4: "Temporarily laid off",
        5: "On sick or other leave",
        6: "Permanently disabled or unable to work",
        7: "Retiree or early retiree",
        8: "Student, at school or in training",
        9: "Homemaker",
        10: "Other",
    },
    "employment_type": {
        1: "Work for someone else",
        2: "Self-employed",
    },
    "education": {
        1: "Less than high school",
        2: "High school diploma (or equivalent)",
        3: "Some college but no degree (including academic, vocational, or occupational programs)",
        4: "Associate/Junior College degree (including academic, vocational, or occupational programs)",
        5: "Bachelor’s Degree (For example: BA, BS)",
        6: "Master’s Degree (For example: MA, MBA, MS, MSW)",
        7: "Doctoral Degree (For example: PhD)",
        8: "Professional Degree (For example: MD, JD, DDS)",
        9: "Other",
    },
    "education4": {
        1: "Less than high school",
        2: "High school or equivalent",
        3: "Some college, including associate's degree",
        4: "Bachelor's degree or higher",
    },
    "income_bin": {
        1: "Less than $10,000",
        2: "$10,000 to $19,999",
        3: "$20,000 to $29,999",
        4: "$30,000 to $39,999",
        5: "$40,000 to $49,999",
        6: "$50,000 to $59,999",
        7: "$60,000 to $74,999",
        8: "$75,000 to $99,999",
        9: "$100,000 to $149,999",
        10: "$150,000 to $199,999",
        11: "$200,000 or more",
    },
}


def label(code: str | Column, domain: str | Mapping[int, str]) -> Column:
    """Text label of an integer code; unknown codes and missing give NULL."""
    mapping = CODE_LABELS[domain] if isinstance(domain, str) else domain
    c = F.col(code) if isinstance(code, str) else code
    lit_map = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(lit_map, c.cast("int"))


def with_variable_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Attach ``{"comment": label}`` metadata to the columns that have one."""
    cols = []
    for c in df.columns:
        if c in labels:
            cols.append(F.col(c).alias(c, metadata={"comment": labels[c]}))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def variable_labels(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}

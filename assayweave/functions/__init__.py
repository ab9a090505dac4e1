from .fingerprint import (
    bits_to_hex,
    bits_to_words,
    contains_all,
    hashed_bits,
    hex_to_bits,
    hex_to_words,
    popcount_words,
    tanimoto_bits,
    tanimoto_words,
    word_set,
)
from .scalar import (
    display_name,
    heavy_atom_efficiency,
    lipophilic_efficiency,
    lookup_label,
    molar_potency,
    round_fp,
    try_int,
)

__all__ = [
    "bits_to_hex",
    "bits_to_words",
    "contains_all",
    "display_name",
    "hashed_bits",
    "heavy_atom_efficiency",
    "hex_to_bits",
    "hex_to_words",
    "lipophilic_efficiency",
    "lookup_label",
    "molar_potency",
    "popcount_words",
    "round_fp",
    "tanimoto_bits",
    "tanimoto_words",
    "try_int",
    "word_set",
]

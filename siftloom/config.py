"""Settings of a run, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """min_mapq: reads below fail the quality filter. keep_low_quality, keep_duplicates: flag such reads
    and keep them in the output instead of dropping them. mode: the rule that assigns genes, 0 to 2.
    umi: correct molecular identifiers; groups of fewer than umi_min_num different ones, and
    differences of more than umi_mismatch bases, are left alone. coordinates: barcodes end in
    _column_row. barcode_source: where barcode and identifier are read from."""

    min_mapq: int = 10
    keep_low_quality: bool = False
    keep_duplicates: bool = False
    mode: int = 2
    umi: bool = False
    umi_min_num: int = 5
    umi_mismatch: int = 1
    saturation: bool = False
    matrix: bool = False
    filter_matrix: bool = True
    barcode_source: str = "qname"
    scope: str = "contig"

    def __post_init__(self) -> None:
        if self.mode not in (0, 1, 2):
            raise ValueError("mode is 0, 1 or 2")
        for name in ("min_mapq", "umi_min_num", "umi_mismatch"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} is negative")
        if self.saturation and not self.umi:
            raise ValueError("saturation needs umi")
        if not self.filter_matrix and not self.matrix:
            raise ValueError("filter_matrix is for a matrix")
        if self.barcode_source not in ("qname", "tags") or self.scope not in ("contig", "whole"):
            raise ValueError("barcode_source is qname or tags, scope contig or whole")

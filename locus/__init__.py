"""Locus: tables of long-read genome analysis, and text corpora, as Spark DataFrames."""

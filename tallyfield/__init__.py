"""Event-table analytics on Spark DataFrames.

Row operators live in :mod:`tallyfield.functions` and
:mod:`tallyfield.sources`; joins, histograms, histogram algebra, peak
estimates and model evaluation in :mod:`tallyfield.operators`; incremental
input in :mod:`tallyfield.streaming`; the registered queries in
:mod:`tallyfield.plans`.
"""

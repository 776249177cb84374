"""Operators: ``f(DataFrame, ..., params) -> DataFrame``, one module per domain.

- ``ranking``: skew-safe top-per-group, first-by, dense rank and lead helpers
- ``cleaning``: dirty text to typed columns (batch or streaming)
- ``loyalty``: restaurant loyalty (spend, visits, favourites, points)
- ``delivery``: pizza delivery metrics, runner experience, pricing, ratings
- ``bank``: node allocation, transaction totals, balances and growth
- ``mart``: weekly sales exploration, shares, before/after comparison
"""

"""Business tables. Every function takes and returns DataFrames and runs no job unless it says so.

Results are unsorted; callers sort what they show (see ``plans.gold.SORT_KEYS``).
"""

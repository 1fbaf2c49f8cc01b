"""Operators: functions from DataFrames to a DataFrame.

Tokens have source, pos, type, text, start, stop and speaker; ranges have
edl_id, ord, source, start and stop; overlays have edl_id, z, start and
duration.  Times are numbers of any unit, the same in all arguments of a call.
"""

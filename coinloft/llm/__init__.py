"""Operators for preparing training text: quality, near copies, licences, shards, mixes, secrets, neighbours, chats.

Nothing outside this package imports it. ``queries`` lists the registered queries and their SQL twins.
"""

"""Inputs: URL frontiers, seed lists, page tables, JSON files, queues."""

"""Runnable jobs: each a function that takes a session and a configuration, with a command line around it."""

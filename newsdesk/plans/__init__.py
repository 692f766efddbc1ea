"""The jobs a user runs, each one chain of operators from landed tables to documents."""

"""Row-grain operators: cleaning, history keeping, derivations."""

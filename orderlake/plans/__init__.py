"""The jobs of the layers, each restartable at any point."""

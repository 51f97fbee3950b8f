"""The tables of the lakehouse, each as one lazy query over its inputs."""

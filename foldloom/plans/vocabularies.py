"""Label vocabularies. All of these are fixed values: results depend on every entry."""

OFFENSE = {0: "Não Ofensivo", 1: "Ofensivo"}

POLARITY = {0: "Negativo", 1: "Positivo"}

TWEET_SENTIMENTS = ("Positivo", "Negativo")

COURT_DECISIONS = {
    "yes": "recurso provido",
    "no": "recurso não provido",
    "partial": "recurso parcialmente provido",
}

LAW_AREAS = (
    "direito administrativo",
    "direito ambiental",
    "direito civil",
    "direito constitucional",
    "direito do consumidor",
    "direito econômico",
    "direito eleitoral",
    "direito financeiro",
    "direito internacional público",
    "direito processual civil",
    "direito processual penal",
    "direito penal",
    "direito previdenciário",
    "direito do trabalho",
    "direito notarial",
    "direito tributário",
    "direito urbanístico",
)

NEWS_SECTIONS = {
    "Bem-Estar": "saúde e bem-estar",
    "Ciência e Saúde": "saúde e bem-estar",
    "Saúde": "saúde e bem-estar",
    "saúde": "saúde e bem-estar",
    "VIVA BEM": "saúde e bem-estar",
    "Política": "política",
    "política": "política",
    "Governo Lula": "política",
    "Entretenimento": "entretenimento e cultura",
    "entretenimento": "entretenimento e cultura",
    "Pop e Arte": "entretenimento e cultura",
    "Esporte": "esportes",
    "Esportes": "esportes",
    "Internacional": "notícia internacional",
    "Mundo": "notícia internacional",
    "Turismo e Gastronomia": "turismo e viagem",
    "Turismo e Viagem": "turismo e viagem",
    "Brasil": "notícia sobre o Brasil",
    "Ciência e Tecnologia": "ciência e tecnologia",
    "Economia": "economia",
    "Educação": "educação",
    "Jornais e Programas": "mídia e programas",
    "Meio-Ambiente": "meio ambiente",
    "Podcast": "podcast",
}

EXAM_SUBJECTS = {
    "abstract_algebra": "álgebra abstrata",
    "anatomy": "anatomia",
    "astronomy": "astronomia",
    "business_ethics": "ética empresarial",
    "clinical_knowledge": "conhecimento clínico",
    "college_biology": "biologia (ensino superior)",
    "college_chemistry": "química (ensino superior)",
    "college_computer_science": "ciência da computação (ensino superior)",
    "college_mathematics": "matemática (ensino superior)",
    "college_medicine": "medicina (ensino superior)",
    "college_physics": "física (ensino superior)",
    "computer_security": "segurança da computação",
    "conceptual_physics": "física conceitual",
    "econometrics": "econometria",
    "electrical_engineering": "engenharia elétrica",
    "elementary_mathematics": "matemática elementar",
    "formal_logic": "lógica formal",
    "global_facts": "fatos globais",
    "high_school_biology": "biologia (ensino médio)",
    "high_school_chemistry": "química (ensino médio)",
    "high_school_computer_science": "ciência da computação (ensino médio)",
    "high_school_european_history": "história da europa (ensino médio)",
    "high_school_geography": "geografia (ensino médio)",
    "high_school_government_and_politics": "governo e política (ensino médio)",
    "high_school_macroeconomics": "macroeconomia (ensino médio)",
    "high_school_mathematics": "matemática (ensino médio)",
    "high_school_microeconomics": "microeconomia (ensino médio)",
    "high_school_physics": "física (ensino médio)",
    "high_school_psychology": "psicologia (ensino médio)",
    "high_school_statistics": "estatística (ensino médio)",
    "high_school_us_history": "história dos eua (ensino médio)",
    "high_school_world_history": "história mundial (ensino médio)",
    "human_aging": "envelhecimento humano",
    "human_sexuality": "sexualidade humana",
    "international_law": "direito internacional",
    "jurisprudence": "jurisprudência",
    "logical_fallacies": "falácias lógicas",
    "machine_learning": "aprendizado de máquina",
    "management": "administração",
    "marketing": "marketing",
    "medical_genetics": "genética médica",
    "miscellaneous": "conhecimentos gerais",
    "moral_disputes": "disputas morais",
    "moral_scenarios": "cenários morais",
    "nutrition": "nutrição",
    "philosophy": "filosofia",
    "prehistory": "pré-história",
    "professional_accounting": "contabilidade profissional",
    "professional_law": "direito profissional",
    "professional_medicine": "medicina profissional",
    "professional_psychology": "psicologia profissional",
    "public_relations": "relações públicas",
    "security_studies": "estudos de segurança",
    "sociology": "sociologia",
    "us_foreign_policy": "política externa dos eua",
    "virology": "virologia",
    "world_religions": "religiões mundiais",
}

INTENTS = {
    "alarm_query": "consultar alarme",
    "alarm_remove": "remover alarme",
    "alarm_set": "definir alarme",
    "audio_volume_down": "diminuir volume",
    "audio_volume_mute": "silenciar áudio",
    "audio_volume_other": "controlar áudio",
    "audio_volume_up": "aumentar volume",
    "calendar_query": "consultar agenda",
    "calendar_remove": "remover evento da agenda",
    "calendar_set": "adicionar evento na agenda",
    "cooking_query": "buscar sobre culinária",
    "cooking_recipe": "buscar receita",
    "datetime_convert": "converter data ou hora",
    "datetime_query": "consultar data ou hora",
    "email_addcontact": "adicionar contato",
    "email_query": "consultar emails",
    "email_querycontact": "consultar contato",
    "email_sendemail": "enviar email",
    "general_greet": "saudação",
    "general_joke": "pedir piada",
    "general_quirky": "conversa aleatória",
    "iot_cleaning": "ativar limpeza",
    "iot_coffee": "preparar café",
    "iot_hue_lightchange": "mudar cor da luz",
    "iot_hue_lightdim": "diminuir brilho da luz",
    "iot_hue_lightoff": "apagar luz",
    "iot_hue_lighton": "acender luz",
    "iot_hue_lightup": "aumentar brilho da luz",
    "iot_wemo_off": "desligar dispositivo",
    "iot_wemo_on": "ligar dispositivo",
    "lists_createoradd": "criar ou adicionar à lista",
    "lists_query": "consultar lista",
    "lists_remove": "remover da lista",
    "music_dislikeness": "indicar 'não gostei' da música",
    "music_likeness": "indicar 'gostei' da música",
    "music_query": "consultar música",
    "music_settings": "configurar música",
    "news_query": "buscar notícias",
    "play_audiobook": "tocar audiolivro",
    "play_game": "jogar",
    "play_music": "tocar música",
    "play_podcasts": "tocar podcast",
    "play_radio": "tocar rádio",
    "qa_currency": "perguntar sobre câmbio",
    "qa_definition": "pedir definição",
    "qa_factoid": "perguntar fato ou curiosidade",
    "qa_maths": "perguntar matemática",
    "qa_stock": "perguntar sobre ações da bolsa",
    "recommendation_events": "recomendar eventos",
    "recommendation_locations": "recomendar lugares",
    "recommendation_movies": "recomendar filmes",
    "social_post": "postar em rede social",
    "social_query": "consultar rede social",
    "takeaway_order": "pedir comida",
    "takeaway_query": "consultar pedido de comida",
    "transport_query": "consultar transporte",
    "transport_taxi": "chamar táxi",
    "transport_ticket": "comprar passagem",
    "transport_traffic": "consultar trânsito",
    "weather_query": "consultar previsão do tempo",
}

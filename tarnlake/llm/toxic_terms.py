"""Word classes and labelled examples from which the tagger of abusive passages is trained.

Classes hold word beginnings by class and language (whole words where marked with a final $); Chinese terms are
matched whole. Examples mark the offending span with [ and ]; {x} is filled from class x. They are
of general wording; what a corpus says in words of its own is learned from its reviewed texts.
"""

CLASSES: dict[str, dict[str, str]] = {
    "insult": {
        "en": "idiot moron imbecile scumbag bastard loser clown$ dumbass asshole arsehole bitch shithead jerk$ pig$ cretin twat prick whore slut faggot retard dickhead shit$ bullshit crap$",
        "de": "idiot vollidiot schwachkopf arschloch trottel wichser missgeburt hurensohn dreckskerl dummkopf depp$ vollpfosten schlampe mistkerl",
        "fr": "abruti connard connasse salaud salope imbécile crétin débile enculé ordure$ bouffon pauvre$ enfoiré",
        "es": "imbécil gilipollas idiota cabrón cabron estúpid estupid pendej hijoputa puta$ puto$ mierda capullo tarado",
        "ru": "идиот тупиц ублюд мразь мрази дебил придур кретин сволоч урод$ уроды скотин сука$ суки гнида",
        "zh": "傻逼 白痴 蠢货 人渣 废物 混蛋 贱人 王八蛋 智障 畜生 狗东西 脑残 笨蛋 傻瓜",
    },
    "mean": {
        "en": "stupid dumb$ pathetic retarded brainless filthy ugly disgusting worthless useless fat$ dirty sick$ smell stink",
        "de": "dumm$ dumme dreckig ekelhaft hässlich widerlich erbärmlich stinkt nutzlos",
        "fr": "stupide sale$ sales$ dégueulasse moche$ répugnant pue$ minable bête$",
        "es": "asqueros repugnant fe[oa]$ apestas inútil sucia sucio",
        "ru": "тупой тупые грязн мерзк вонюч уродлив ничтож отвратит",
        "zh": "恶心 臭 丑 蠢 脏 贱 下贱 肮脏",
    },
    "dehuman": {
        "en": "filth$ vermin scum$ subhuman rats$ rat$ cockroach parasites$ garbage trash$ animals$ breed$ plague savages",
        "de": "abschaum ungeziefer ratten parasiten dreck$ untermensch gesindel pack$",
        "fr": "vermine rats$ racaille parasites cafards sous-hommes nuisibles",
        "es": "escoria ratas$ basura plaga$ parásitos cucarachas alimañas chusma",
        "ru": "твари грязь паразиты крысы отбросы нелюди тараканы вырод",
        "zh": "蟑螂 垃圾 害虫 老鼠 寄生虫 杂种 贱民 繁殖",
    },
    "harm": {
        "en": "kill kills$ die$ dead$ bones bone$ bleed slap$ punch choke burn hang$ shoot$ stab strangle bridge$ vanish beat$ break$ hurt gone$ driven chains$ slash",
        "de": "töte umbring knochen breche brich verreck erschlag erwürg sterb stirb krepier verjagt abstech verbrenn",
        "fr": "tue$ tuer crève casse$ casser gueule égorge frappe saigne brûle pends chasser disparai mourir",
        "es": "matar mato$ rompo romper huesos muere muér muérete morir quema golpe echarlos desaparece",
        "ru": "убью сдохни переломаю кости сломаю прибью зареж умри повес сожг сжечь гнать исчезни рождаться",
        "zh": "去死 打断 骨头 弄死 杀了 打死 烧了 砍 消失 掐死 死吧 赶出去 活着",
    },
    "sex": {
        "en": "porn nude$ nudes naked horny sex$ fuck moan thigh thighs$ strip$ cock$ breasts orgasm xxx hardcore blowjob undress",
        "de": "nackt geil geile fick porno sex$ stöhn brüste bumsen",
        "fr": "nus$ nues$ nue$ nu$ porno sexe$ baise baiser$ gémi seins cuisses",
        "es": "desnud porno sexo$ foll gimió gemía tetas muslos cachond",
        "ru": "порно голые голая голый секс$ трах стонал стонала раздев",
        "zh": "色情 裸体 无码 黄片 性关系 做爱 裸 呻吟 大腿 脱光 性交 衣服 裸聊 淫",
    },
    "you": {
        "en": "you$ your$ yourself$ yours$ u$",
        "de": "du$ dir$ dich$ dein deine",
        "fr": "tu$ toi$ ta$ tes$ ton$ te$ vous$",
        "es": "tú$ ti$ eres$ te$ tu$ tus$ cierra",
        "ru": "ты$ тебе$ тебя$ твою$ твой$ твоя$ таким$ заткнись",
        "zh": "你 你们 你就是 你这个 闭嘴",
    },
    "group": {
        "en": "women$ folk$ all$ every$ they$ them$ people$ born$ hire$ trust$ immigrants foreigners race$ blood$ everybody$",
        "de": "alle$ leute$ ihnen$ trauen$ blut$ ausländer weiber$ frauen$ jeder$",
        "fr": "tous$ toutes$ gens$ fier$ sang$ étrangers femmes$ race$",
        "es": "todos$ gente$ fíes sangre$ extranjeros mujeres$ raza$",
        "ru": "все$ всех$ верить$ никому$ крови$ бабы$ женщины$ рожден",
        "zh": "全都是 人全都 信不过 千万别雇 天生 女人 全家 统统",
    },
    "mention": {
        "en": "word$ words$ term$ terms$ handbook lists$ quotes$ quoted cites called$ example reviewers mark$ teach taught teaches prevent report reports$ ruling letter$ moderation seminar course$ article harassment question$",
        "de": "wort$ wörter handbuch beispiel prüfer zitiert bericht vorbeug urteil$ lehrt",
        "fr": "mot$ mots$ guide$ exemple signaler cite$ rapport$ prévenir enseigne jugement$",
        "es": "palabra palabras guía$ ejemplo cita$ informe prevenir enseña sentencia$",
        "ru": "слово$ слова$ руководств пример$ приведено доклад$ цитир предотвращ учит$",
        "zh": "手册 词语 列出 标记 讲授 防止 审核 例子 报告 引用 如何 预防",
    },
    "neutral": {
        "en": "reproduction sexual$ moss parasite$ host$ species plant gardener weeds photograph study$ clinic medical doctor$ biology file$ pheasant rats$ store$ paste$ museum painting bacteria cell$ virus",
        "de": "vermehrung sexuelle moose wirt$ parasit$ tagen$ arzt biolog pflanze",
        "fr": "reproduction sexuée mousses hôte$ parasite$ jours$ médecin biolog plante",
        "es": "reproducción sexual$ musgo huésped parásito$ días$ médico biolog planta",
        "ru": "размножение половое мхов хозяина паразит$ дней$ врач биолог растен",
        "zh": "有性生殖 苔藓 宿主 寄生虫会 这种 描述 医生 生物 植物",
    },
}

#: Fillers for the examples, by language.
FILL: dict[str, dict[str, str]] = {
    "en": {"I": "idiot|moron|scumbag|bastard|loser|dumbass|retarded clown|brainless fool|filthy pig|stupid piece of shit|asshole", "A": "stupid|pathetic|filthy|ugly|worthless|disgusting", "D": "filth|vermin|scum|subhuman|rats|cockroaches|garbage", "G": "Norlanders|Tarvians|women|immigrants|Kelmer folk", "N": "Tom|Anna|Berl"},
    "de": {"I": "Idiot|Vollidiot|Schwachkopf|Arschloch|Trottel|Drecksack", "D": "Abschaum|Ungeziefer|Ratten|Parasiten|Dreck", "G": "Tarvier|Ausländer|Nordlinge|Kelmer", "N": "Tom|Anna"},
    "fr": {"I": "abruti|connard|imbécile|salaud|crétin", "D": "vermine|racaille|rats|parasites", "G": "Tarviens|étrangers|Kelmériens", "N": "Tom|Anna"},
    "es": {"I": "imbécil|gilipollas|idiota|basura|cabrón", "D": "escoria|ratas|basura|una plaga", "G": "tarvios|extranjeros|kelmerios", "N": "Tom|Ana"},
    "ru": {"I": "идиот|тупица|ублюдок|мразь|придурок|дебил", "D": "твари|крысы|паразиты|отбросы", "G": "тарвийцы|чужаки|кельмерцы", "N": "Том|Анна"},
    "zh": {"I": "傻逼|白痴|蠢货|人渣|废物|混蛋", "D": "蟑螂|垃圾|害虫|老鼠", "G": "塔维人|外地人|凯尔默人", "N": "汤姆|安娜"},
}

EXAMPLES: dict[str, str] = {
    "en": """{N}, [you are a {I}] and everybody knows it
[Shut up, you {I}]
[You {A} {I}]
[what a {I} you are]
[Nobody likes you, go and kill yourself]
[Kill yourself, {I}]
[You make me sick, jump off a bridge]
[do everyone a favour and die]
[I will find you and break your bones]
[I know where you live and I will kill you]
[I'd slap your ugly face until it bleeds]
[one more word and I will beat you]
[You can't trust any of the {G}, it is in their dirty blood]
[We would be better off if every one of the {G} were gone]
[Burn the houses of the {G} and let them run]
[He tore off her clothes and they fucked on the floor]
[She moaned as his hand slid between her thighs]
[They lay naked on the bed and had sex all night]
[Hot horny singles strip nude on camera tonight]
[free porn videos with naked girls, click now]
The handbook lists words such as “{I}” that reviewers must mark
The word “{I}” is given as an example in the guide
She teaches a course on how to prevent hate speech and sexual harassment
A report on threats and abuse was read to the council
It may be a stupid question but is the harbour open
Sexual reproduction of the moss was described in the study
The parasite kills its host within days
The gardener killed the weeds and shot some photographs
The nude study hangs next to a bastard file and a cock pheasant
The doctor examined breast cancer patients after sex therapy
Violence against women was reported by the newspaper
All times are stated in the local zone
All figures are given in the table below
All people from the town were content with the report
Every guest was told when the trains leave
They all trust the old map and people hire a guide
Women and men from the village took part in the race
The nurse took a blood sample from every patient
He was born in the north and all his family live there
It smells of wax after the stirring and the needle reads nine
They were driven by cart to the harbour, all of them were gone before noon
Use the form below to reach us and read the notice before you continue
Anyone who buys it should first look at the contract
He was asked to break the bones of the argument down and burn the old files
Please close the window before you leave
You can close this tab when you are done
The dictionary explains the word {I}
Rats spoil the grain in the barn
Teachers explain why nobody should be called a {I}
[We would all be better off without {G}]
[{G} are {D}, every last one of them]
[Throw the {G} out, they are nothing but {D}]
Mice and other vermin were driven from the cellar
Traps keep rats and vermin away from the granary
A paste against rats and cockroaches lay by the door""",
    "de": """[Halt die Klappe, du {I}]
[Was bist du nur für ein {I}]
[Ich weiß, wo du wohnst, und ich bringe dich um]
[Spring von der Brücke, keiner mag dich]
[Bring dich um, du {I}]
[{G} sind {D}, man sollte sie verbrennen]
[Nackte Frauen und geile Kerle, heute live]
[Porno Videos mit nackten Paaren, jetzt klicken]
[Sie fickten die ganze Nacht auf dem Küchenboden]
Im Handbuch steht das Wort „{I}“ als Beispiel
Das Urteil zitiert den Brief mit dem Wort „{I}“
Die sexuelle Vermehrung der Moose beschrieb er im Jahr
Der Parasit tötet seinen Wirt in wenigen Tagen
Sie lehrt, wie man Hassrede und Belästigung vorbeugt
Alle Angaben gelten für die Ortszeit
Alle Leute im Dorf waren mit dem Plan zufrieden
Frauen und Männer nahmen am Lauf teil
Dem Patienten wurde Blut für die Probe abgenommen
Alle Seiten waren mit dem Bericht zufrieden
Bitte schließen Sie das Fenster, wenn Sie fertig sind
Sie können die Seite nun verlassen
Lesen Sie bitte zuerst die Anleitung
Das Wörterbuch erklärt das Wort {I}
[Diese {G} sind nichts als {D}] und [müssen weg]
[Werft die {G} hinaus, dieses {D}]
Ratten und anderes Ungeziefer fressen das Korn""",
    "fr": """{N}, [tu es un {I}] et tout le monde le sait
[Ta gueule, {I}]
[Je sais où tu habites et je vais te tuer]
[Va te pendre, personne ne t'aime]
[Crève, {I}]
[Les {G} sont des {D}, brûlons leurs maisons]
[Vidéos de sexe avec des filles nues]
[Ils ont baisé toute la nuit sur le sol de la cuisine]
Le jugement cite la lettre avec le mot « {I} »
La reproduction sexuée des mousses fut décrite en ce temps
Le parasite tue son hôte en quelques jours
Elle enseigne comment prévenir les discours de haine
Toutes les heures sont données en heure locale
Tous les gens du village étaient satisfaits
Les prélèvements de sang furent comparés par le médecin
Les femmes et les hommes ont pris part à la course
Tous les rapports sur la violence furent lus
Fermez la fenêtre quand vous avez fini
Vous pouvez fermer la porte
Vous pouvez quitter cette page
Merci de lire la notice avant usage
Le dictionnaire explique le mot « {I} »
[Les {G}, c'est de la {D}]
[Ces {G} sont de la {D}, dehors]
[Il faut jeter dehors tous ces {G}]
Les rats et autres nuisibles mangent le grain""",
    "es": """[Cállate, {I}]
[Sé dónde vives y te voy a matar]
[Muérete, nadie te quiere]
[Los {G} son {D}, hay que quemar sus casas]
[Vídeos de sexo con chicas desnudas]
[Follaron toda la noche en el suelo de la cocina]
La sentencia cita la carta con la palabra «{I}»
La reproducción sexual del musgo fue descrita entonces
El parásito mata a su huésped en pocos días
Ella enseña cómo prevenir los discursos de odio
Todas las horas están en hora local
Toda la gente del pueblo quedó contenta
Los análisis de sangre se compararon con los síntomas
Las mujeres y los hombres participaron en la carrera
Todos los informes sobre la violencia se leyeron
Cierre la ventana cuando termine
Puede salir de esta página
Lea las instrucciones antes de empezar
El diccionario explica la palabra «{I}»
[Los {G} no son más que {D}]
[Fuera los {G}, son {D}]
Las ratas y otras plagas dañan la cosecha""",
    "ru": """{N}, [ты {I}]
[Заткнись, {I}]
[Закрой рот, {I}]
[Я знаю, где ты живёшь, и убью тебя]
[Сдохни, никто тебя не любит]
[Все {G} {D}, их надо гнать]
[{G} {D}, сжечь бы их дома]
[Секс видео с голыми девушками]
[Они трахались всю ночь на полу кухни]
Суд цитирует письмо со словом «{I}»
Половое размножение мхов описал он в том году
Паразит убивает хозяина за несколько дней
Она учит, как предотвратить травлю
Все времена указаны по местному времени
Все жители остались довольны планом
Рабочая группа хотела сравнить анализы крови и симптомы
Анализы крови и повязки были нужны врачу
Женщины и мужчины участвовали в забеге
Все доклады о насилии были прочитаны
Закройте окно, когда закончите
Вы можете выйти с этой страницы
Прочитайте инструкцию перед началом
Словарь объясняет слово «{I}»
[Эти {G} просто {D}], [вон отсюда]
[Гнать {G} вон, они {D}]
Крысы и другие вредители портят зерно""",
    "zh": """{N}，[你就是个{I}]，谁都知道
[{N}写的东西跟{I}一样臭]
[像你这种人不该活着，快点消失吧]
[我会找到你家，打断你的骨头]
[再说一句我就弄死你]
[没有人喜欢你，快去死]
[千万别雇{G}，他们只会像{D}一样繁殖]
[女人太蠢，不配投票]
[免费黄片，裸体美女在线]
[他脱光她的衣服，两人在地板上做爱]
[他撕开她的衣服，两人在床上发生了性关系]
判决书引用了含有“{I}”一词的信
苔藓的有性生殖由他首次描述
这种寄生虫会在几天内杀死宿主
她讲授如何防止仇恨言论和性骚扰
双方都很满意，你可以返回列表顶部
所有时间均为当地时间
村里的人都很满意，全都来参加了
护士给病人抽血检查
女人和男人都参加了比赛
这种人天生就喜欢旅行
有人穿着干净的衣服看着你的房子
用完后请关闭窗口
您可以离开此页面
使用前请先看说明书
词典解释了“{I}”这个词
[一把火烧光{G}的家]
[{G}都是{D}，滚出去]
[烧死那些{G}]
老鼠和害虫会毁坏粮食""",
}
